"""Arrow batches of bounded size for operators that read whole texts, broadcasts of counted keys, rows under one name."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS, BYTES = 1000, 4 << 20
FEW_KEYS = 500_000  # rows of at most an id and a digest: some 30 MB


def bound_batches(spark: SparkSession, most_bytes: int = BYTES) -> None:
    """Rows of long texts come in small batches, so a Python worker's memory follows the longest text, not the batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(RECORDS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most_bytes))


def few_or_hashed(keys: DataFrame) -> DataFrame:
    """A (written) table of keys for a join with whole texts: broadcast when a count shows it is small, else hashed on both sides."""
    return F.broadcast(keys) if keys.count() <= FEW_KEYS else keys.hint("shuffle_hash")


def packed(docs: DataFrame) -> DataFrame:
    """The rows as one struct column ``doc``, so that columns added beside it cannot clash with any of theirs; ``doc.*`` unpacks."""
    return docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("doc"))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def return_memory() -> None:
    """At a task's end: give freed memory back to the system, since Spark keeps its Python workers for the stages that follow."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: its own policy holds
        pass
