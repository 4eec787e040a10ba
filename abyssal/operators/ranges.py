"""Time windows over whole sets of tables, deployment lists and overviews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import add_seconds
from abyssal.schemas import KEY, TIME_COLUMN

# Named ranges in seconds, counted back from the end of the data.
PRESETS = {"All data": None, "Last hour": 3600, "Last 6 hours": 21_600, "Last 24 hours": 86_400, "Last 7 days": 604_800}


def time_column(name: str) -> str | None:
    return TIME_COLUMN[name]


def clip(df: DataFrame, deployments: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows in their deployment's window ``[start, end)``; an open end is no bound.

    The window table has one row per deployment; Spark broadcasts it while it is small.
    """
    bounds = deployments.select(KEY, F.col("start").alias("__start"), F.col("end").alias("__end"))
    keep = (F.col(ts) >= F.col("__start")) & (F.col("__end").isNull() | (F.col(ts) < F.col("__end")))
    return df.join(bounds, KEY).where(keep).select(*df.columns)


def clip_tables(tables: dict[str, DataFrame], deployments: DataFrame) -> dict[str, DataFrame]:
    """Every table by its own time column, fluxes and metabolism by experiment start; timeless ones pass."""
    return {n: df if time_column(n) is None else clip(df, deployments, time_column(n)) for n, df in tables.items()}


def filter_to_range(tables: dict[str, DataFrame], bounds: DataFrame) -> dict[str, DataFrame]:
    """Inclusive range (`bounds`: deployment_id, lo, hi) over every table with a reading time."""
    out = {}
    for name, df in tables.items():
        ts = time_column(name)
        if ts not in ("ts", "timestamp"):
            out[name] = df
            continue
        b = bounds.select(KEY, F.col("lo").alias("__lo"), F.col("hi").alias("__hi"))
        out[name] = df.join(b, KEY).where(F.col(ts).between(F.col("__lo"), F.col("__hi"))).select(*df.columns)
    return out


def overview(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and time span per table and deployment."""
    parts = []
    for name, df in tables.items():
        ts = time_column(name)
        has_time = ts in ("ts", "timestamp")
        t = F.col(ts) if has_time else F.lit(None).cast("timestamp_ntz")
        parts.append(df.groupBy(KEY).agg(F.count(F.lit(1)).alias("rows"), F.min(t).alias("first_ts"), F.max(t).alias("last_ts")).withColumn("table", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b), parts).select(KEY, "table", "rows", "first_ts", "last_ts")


def time_bounds(tables: dict[str, DataFrame]) -> DataFrame:
    """Earliest and latest time over all tables, per deployment."""
    timed = {n: df for n, df in tables.items() if time_column(n) in ("ts", "timestamp")}
    return overview(timed).groupBy(KEY).agg(F.min("first_ts").alias("lo"), F.max("last_ts").alias("hi")).where("lo IS NOT NULL")


def preset_ranges(bounds: DataFrame) -> DataFrame:
    """Every named range per deployment, anchored at the end of its data."""
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("preset"), F.lit(s).cast("double").alias("seconds")) for n, s in PRESETS.items()]))
    rows = bounds.select(KEY, "lo", "hi", named.alias("p")).select(KEY, "lo", "hi", "p.preset", "p.seconds")
    start = F.when(F.col("seconds").isNull(), F.col("lo")).otherwise(F.greatest("lo", add_seconds(F.col("hi"), -F.col("seconds"))))
    return rows.select(KEY, "preset", start.alias("range_start"), F.col("hi").alias("range_end"))


def date_range(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """Whole days from `first` to `last`, clamped to the data."""
    day_end = add_seconds(F.date_add(last, 1).cast("timestamp_ntz"), -1e-6)
    return bounds.select(
        KEY, F.greatest("lo", first.cast("timestamp_ntz")).alias("range_start"), F.least("hi", day_end).alias("range_end")
    )


def experiments_in_range(starts: DataFrame, bounds: DataFrame) -> DataFrame:
    """Experiments whose start is in the inclusive range; numbering is never changed by a range."""
    return starts.join(bounds.select(KEY, "lo", "hi"), KEY).where("experiment_start BETWEEN lo AND hi").drop("lo", "hi")


def keep_experiments(df: DataFrame, experiments: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """All rows of the listed experiments."""
    on = [*keys, "experiment_number"]
    return df.join(experiments.select(*on), on, "left_semi")


def with_condition(df: DataFrame, deployments: DataFrame) -> DataFrame:
    """Add the chamber's treatment as `condition`."""
    d = deployments.select(KEY, F.col("c1").alias("__c1"), F.col("c2").alias("__c2"))
    chamber = F.col("chamber")
    condition = F.when(chamber == "C1", F.col("__c1")).when(chamber == "C2", F.col("__c2"))
    return df.join(d, KEY, "left").withColumn("condition", condition).drop("__c1", "__c2")


def list_deployments(deployments: DataFrame, tables: dict[str, DataFrame], show_test: bool = False) -> DataFrame:
    """Deployments that have any output table, with a label; test ones hidden unless asked, newest id first.

    Output without metadata still counts, as a non-test deployment.
    """
    have = reduce(lambda a, b: a.unionByName(b), [df.select(KEY) for df in tables.values()]).distinct()
    rows = have.join(deployments.select(KEY, "site", "test"), KEY, "left")
    if not show_test:
        rows = rows.where(~F.coalesce("test", F.lit(False)))
    label = F.concat(F.col(KEY), F.lit(" — "), F.col("site"), F.when(F.col("test"), F.lit(" (TEST)")).otherwise(F.lit("")))
    return rows.select(
        KEY, "site", "test", F.when(F.col("test").isNull(), F.concat(F.col(KEY), F.lit(" (no deployment.toml)"))).otherwise(label).alias("label")
    ).orderBy(F.desc(KEY))
