"""Time arithmetic, guarded division and session helpers used by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_col(value: str | float | Column) -> Column:
    """A column from a column name, a number or a column."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(float(value))


def micros(ts: str | Column) -> Column:
    """Naive UTC timestamp as whole microseconds since 1970 (the session time zone is UTC)."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def add_seconds(ts: Column, seconds: float | Column) -> Column:
    us = F.round(as_col(seconds) * 1e6).cast("bigint")
    return from_micros(micros(ts) + us)


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds, exact to the microsecond."""
    return (micros(end) - micros(start)) / F.lit(1e6)


def whole_seconds(elapsed_us: Column) -> Column:
    """Whole seconds of a duration in microseconds, truncated towards zero."""
    return ((elapsed_us - elapsed_us % F.lit(1_000_000)) / F.lit(1_000_000)).cast("bigint")


def whole_minutes(elapsed_us: Column) -> Column:
    """Elapsed minutes counted from whole seconds."""
    return whole_seconds(elapsed_us) / F.lit(60.0)


def safe_div(a: Column, b: Column) -> Column:
    """Null instead of an error when the divisor is zero."""
    return F.try_divide(a, b)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    A filter over a plain column moves below it and repeats its expression wherever it names it; it does not move below a generator.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def use_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the one the cluster shares; a local session without one gets its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir is not set; {master} needs a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4()}"


def remove_dirs(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediate folders that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    paths.clear()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for loops whose plan would otherwise grow with every pass."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def write_and_read(df: DataFrame, made: list[str] | None = None) -> DataFrame:
    """Materialise a shared intermediate once, as a Parquet table in the shared folder; ``made`` collects its path for `remove_dirs`."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    if made is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
