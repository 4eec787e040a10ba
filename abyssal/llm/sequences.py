"""Sequences whose key may hold a third of all rows: dealt by ranges of (key, order), so that one key spreads over many tasks.

What each task finds of a key leaves it as pieces of bounded size. Only the digest of a whole sequence needs its pieces one after the
other: `hashed_in_order` streams them and keeps nothing but the state of the hash.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ROWS_PER_TASK = 50_000
PIECE_CHARS = 1 << 20
OUT_ROWS, OUT_CHARS = 2000, 8 << 20


def tasks_for(rows: int, least: int = 8) -> int:
    return max(least, 1 + rows // ROWS_PER_TASK)


def in_ranges(df: DataFrame, by: Sequence[Column], tasks: int) -> DataFrame:
    """Rows sorted by the columns (nulls first) over all tasks; equal rows are told apart by their place in the input, so they split too."""
    keys = [f"__k{i}" for i in range(len(by))]
    placed = df.withColumns(dict(zip(keys, by)) | {"__place": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first(k) for k in keys] + [F.asc("__place")]
    return placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop(*keys, "__place")


def arrow_rows(df: DataFrame, ddl: str, work: Callable[[Iterator[tuple], int], Iterator[tuple]], size: Callable[[tuple], int] = lambda r: 0) -> DataFrame:
    """mapInArrow over plain tuples: ``work(rows, task number)`` yields rows of the schema ``ddl``, which leave in batches of bounded size."""
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
        held: list[tuple] = []
        chars = 0
        for row in itertools.chain(work(rows, TaskContext.get().partitionId()), [None]):
            if row is not None:
                held.append(row)
                chars += size(row)
            if held and (row is None or len(held) >= OUT_ROWS or chars >= OUT_CHARS):
                columns = list(zip(*held))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
                held, chars = [], 0

    return df.mapInArrow(run, schema)


def pieces_of(df: DataFrame, key: str, number: str, tasks: int, separator: str = ",") -> DataFrame:
    """(key, part, piece, text): the numbers of every key in ascending order, joined as decimals, in pieces of bounded size."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, part int, piece bigint, text string"

    def work(rows: Iterator[tuple], task: int) -> Iterator[tuple]:
        for k, run in itertools.groupby(rows, key=lambda r: r[0]):
            texts, held, piece = [], 0, 0
            for _, v in run:
                texts.append(str(v))
                held += len(texts[-1]) + 1
                if held >= PIECE_CHARS:
                    yield k, task, piece, separator.join(texts)
                    texts, held, piece = [], 0, piece + 1
            if texts:
                yield k, task, piece, separator.join(texts)

    return arrow_rows(in_ranges(df.select(key, number), [F.col(key), F.col(number)], tasks), schema, work, lambda r: len(r[3]))


def hashed_in_order(pieces: DataFrame, key: str, texts: dict[str, str], tasks: int) -> DataFrame:
    """(key, then for each text column its sha256 and its code points) of the pieces of a key in order of (part, piece).

    ``texts`` names the text columns and what separates their pieces; null texts are passed over. The digest of a sequence is
    sequential by nature, so the pieces of one key go through one task, as a stream.
    """
    kind = pieces.schema[key].dataType.simpleString()
    schema = ", ".join([f"`{key}` {kind}"] + [f"{t}_sha256 string, {t}_chars bigint" for t in texts])
    separators = [s.encode() for s in texts.values()]

    def work(rows: Iterator[tuple], task: int) -> Iterator[tuple]:
        for k, run in itertools.groupby(rows, key=lambda r: r[0]):
            states, chars, begun = [sha256() for _ in texts], [0] * len(texts), [False] * len(texts)
            for _, *values in run:
                for i, t in enumerate(values):
                    if t is not None:
                        states[i].update((separators[i] if begun[i] else b"") + t.encode())
                        chars[i] += len(t)
                        begun[i] = True
            yield k, *[v for s, c in zip(states, chars) for v in (s.hexdigest(), c)]

    dealt = pieces.repartition(tasks, key).sortWithinPartitions(key, "part", "piece").select(key, *texts)
    return arrow_rows(dealt, schema, work)
