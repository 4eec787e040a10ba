"""Exact medians and least-squares fits as distributed aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abyssal.functions.common import write_and_read
from abyssal.functions.exact import exact_avg, exact_sum

FEW_GROUPS = 100_000  # rows of a few keys each: some 20 MB


def _value_bucket(scale: int) -> Column:
    """Order-preserving bucket of ``__v``: ``scale`` per doubling of the magnitude, through zero, infinities outermost."""
    v = F.col("__v")
    size = F.when(F.abs(v) == float("inf"), F.lit(1100 * scale)).otherwise(F.floor(F.log2(F.abs(v)) * scale))
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v) * (size + 1100 * scale)).cast("bigint")


def _few_or_merged(wanted: DataFrame) -> DataFrame:
    """A written table of groups for a join with many rows: broadcast when a count shows it is small, else both sides are sorted.

    The many rows are never broadcast: Spark goes by their size on disk, which repeated values make a hundred times less than in memory.
    """
    return F.broadcast(wanted) if wanted.count() <= FEW_GROUPS else wanted.hint("merge")


def _narrow(v: DataFrame, groups: list[str], bucket: str, wanted: DataFrame) -> DataFrame:
    """Wanted ranks (`__r` within the groups) moved into the bucket that holds them; one row per bucket is ordered."""
    hist = v.groupBy(*groups, bucket).agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    met = hist.withColumn("__upto", F.sum("__n").over(upto)).join(_few_or_merged(wanted), groups)
    met = met.where("__r <= __upto AND __r > __upto - __n")
    return met.select(*groups, bucket, (F.col("__r") - (F.col("__upto") - F.col("__n"))).alias("__r"))


def exact_median(df: DataFrame, keys: Sequence[str], value: Column, name: str = "median") -> DataFrame:
    """Exact median per key (mean of the two middle values), without holding a group in one task.

    Spark's own exact median keeps a group's values in one aggregation buffer. Here histograms over two monotone buckets of
    the value, the second finer, find the place of each middle rank; only values there are ordered, and equal ones are
    counted map-side first.
    """
    keys = list(keys)
    v = df.select(*keys, value.cast("double").alias("__v")).where("__v IS NOT NULL AND NOT isnan(__v)")
    v = v.withColumns({"__b": _value_bucket(64), "__f": _value_bucket(1 << 20)})
    wanted = v.groupBy(*keys).agg(F.count(F.lit(1)).alias("__all"))
    middle = F.array(F.floor((F.col("__all") + 1) / 2), F.floor((F.col("__all") + 2) / 2))
    # Places of ranks and the medians, a row or two per key, are written: each is read twice, and joins know their size.
    wanted = write_and_read(wanted.select(*keys, F.explode(middle).alias("__r")))
    groups, rows = keys, v
    for bucket in ("__b", "__f", "__v"):
        if groups != keys:
            rows = v.join(_few_or_merged(wanted), groups, "left_semi")
        wanted = write_and_read(_narrow(rows, groups, bucket, wanted))
        groups = [*groups, bucket]
    return write_and_read(wanted.groupBy(*keys).agg(F.avg("__v").alias(name)))


def line_fit(df: DataFrame, keys: Sequence[str], x: Column, y: Column, *extra: Column) -> DataFrame:
    """Ordinary least squares of y on x per key: slope, intercept, r2, n; no row without two distinct x.

    r2 is 1 for a flat line. Rows with a null x or y do not count. Points are first shifted and scaled (by powers of two) to their
    own range, means come next and every sum is exact, so the result does not depend on how rows are dealt; the windows and the
    aggregate share one exchange of the points.
    """
    keys = list(keys)
    group = Window.partitionBy(*keys)
    rows = df.where(x.isNotNull() & y.isNotNull()).withColumns({"__x": x.cast("double"), "__y": y.cast("double")})
    low = {f"__{a}{n}": f(f"__{a}").over(group) for a in "xy" for n, f in (("lo", F.min), ("hi", F.max))}
    rows = rows.withColumns(low)
    for a in "xy":
        span = F.col(f"__{a}hi") - F.col(f"__{a}lo")
        rows = rows.withColumn(f"__{a}unit", F.when(span > 0, F.pow(F.lit(2.0), F.floor(F.log2(span)))).otherwise(F.when(span == 0, 1.0).otherwise(span)))
        rows = rows.withColumn(f"__{a}", (F.col(f"__{a}") - F.col(f"__{a}lo")) / F.col(f"__{a}unit"))
    rows = rows.withColumns({"__mx": exact_avg("__x", group), "__my": exact_avg("__y", group)})
    dx, dy = F.col("__x") - F.col("__mx"), F.col("__y") - F.col("__my")
    same = ["__mx", "__my", "__xlo", "__xhi", "__ylo", "__yhi", "__xunit", "__yunit"]
    sums = {"__xx": dx * dx, "__xy": dx * dy, "__yy": dy * dy}
    fit = rows.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in same], *[exact_sum(c).alias(n) for n, c in sums.items()], F.count(F.lit(1)).alias("n"), *extra
    ).where("__xlo < __xhi")
    flat = F.col("__ylo") == F.col("__yhi")
    slope = F.when(flat, 0.0).otherwise(F.col("__xy") / F.col("__xx") * (F.col("__yunit") / F.col("__xunit")))
    r2 = F.when(flat, 1.0).otherwise(F.try_divide(F.col("__xy") * F.col("__xy"), F.col("__xx") * F.col("__yy")))
    mean = {a: F.col(f"__{a}lo") + F.col(f"__m{a}") * F.col(f"__{a}unit") for a in "xy"}
    named = fit.columns[len(keys) + len(same) + len(sums) + 1:]
    return fit.withColumn("slope", slope).select(*keys, "slope", (mean["y"] - F.col("slope") * mean["x"]).alias("intercept"), r2.alias("r2"), "n", *named)
