"""Equal-spread test across setpoints, its p-value and adjustment, and the noise model fit."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abyssal.functions.common import cut_lineage, safe_div, write_and_read
from abyssal.operators.setpoint import with_differences
from abyssal.operators.stats import exact_median
from abyssal.schemas import KEY

MIN_PER_SETPOINT = 3
FINITE = "x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')"
NOISE_ITERATIONS, NOISE_TOLERANCE = 60, 1e-10
DAMPING = (0.0, 0.01, 1.0, 100.0)


def successive_pairs(tagged: DataFrame, value: str = "current", relative: bool = True) -> DataFrame:
    """Non-overlapping successive differences per hold and mass, over the hold mean when relative."""
    kept = tagged.where(~F.col("in_settle") & F.col(value).isNotNull())
    rows = with_differences(kept, value, [KEY, "segment", "mass"], number_rows=True)
    rows = rows.where("i % 2 = 1")
    if not relative:
        return rows.select(KEY, "mass", "setpoint", F.col("diff").alias("x")).where(FINITE)
    means = kept.groupBy(KEY, "segment", "mass").agg(F.avg(value).alias("__mean"))
    x = safe_div(F.col("diff"), F.col("__mean"))
    return rows.join(means, [KEY, "segment", "mass"]).select(KEY, "mass", "setpoint", x.alias("x")).where(FINITE)


def brown_forsythe(pairs: DataFrame, group: str = "setpoint", keys: Sequence[str] = (KEY, "mass")) -> DataFrame:
    """F statistic of equal spread around the group medians; groups below three values do not count."""
    keys, pairs = list(keys), write_and_read(pairs)
    sized = pairs.groupBy(*keys, group).agg(F.count(F.lit(1)).alias("__n")).where(f"__n >= {MIN_PER_SETPOINT}")
    centre = exact_median(pairs, [*keys, group], F.col("x"), "__median").join(sized, [*keys, group])
    z = F.abs(F.col("x") - F.col("__median"))
    groups = pairs.join(centre, [*keys, group]).groupBy(*keys, group).agg(
        F.count(F.lit(1)).alias("n_i"), F.avg(z).alias("mean_i"), (F.var_pop(z) * F.count(F.lit(1))).alias("ss_i")
    )
    grand = F.sum(F.col("n_i") * F.col("mean_i")).over(Window.partitionBy(*keys)) / F.sum("n_i").over(Window.partitionBy(*keys))
    total = groups.withColumn("__grand", grand).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_setpoints"), F.sum("n_i").alias("n"),
        F.sum(F.col("n_i") * F.pow(F.col("mean_i") - F.col("__grand"), 2)).alias("between"), F.sum("ss_i").alias("within"),
    ).where("n_setpoints >= 2")
    df1, df2 = F.col("n_setpoints") - 1, F.col("n") - F.col("n_setpoints")
    return total.select(*keys, F.lit("Brown-Forsythe").alias("test"), "n_setpoints", "n",
                        safe_div(df2 * F.col("between"), df1 * F.col("within")).alias("statistic"))


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz), element-wise."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 400):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + term * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + term / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
    return h


def f_tail_values(f: np.ndarray, df1: np.ndarray, df2: np.ndarray) -> np.ndarray:
    """Upper tail of the F distribution: the regularised incomplete beta I_x(df2/2, df1/2), x = df2/(df2+df1 F)."""
    f, df1, df2 = (np.asarray(v, dtype=float) for v in (f, df1, df2))
    a, b = df2 / 2, df1 / 2
    x = df2 / (df2 + df1 * f)
    gamma = np.vectorize(math.lgamma, otypes=[float])
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(gamma(a + b) - gamma(a) - gamma(b) + a * np.log(x) + b * np.log1p(-x))
    low = x < (a + 1) / (a + b + 2)
    xs, as_, bs = np.where(low, x, 1 - x), np.where(low, a, b), np.where(low, b, a)
    part = front * _beta_fraction(as_, bs, xs) / as_
    out = np.where(low, part, 1 - part)
    return np.where(x >= 1, 1.0, np.where(x <= 0, 0.0, out))


def _f_tail_batches(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for f, df1, df2 in batches:
        out = pd.Series(np.nan, index=f.index)
        ok = f.notna()
        out[ok] = f_tail_values(f[ok], df1[ok], df2[ok])
        yield out.where(ok, None)


def f_tail(statistic: Column, df1: Column, df2: Column) -> Column:
    """P-value of the F statistic; the only Python here, over the few rows left after the aggregates."""
    return F.pandas_udf(_f_tail_batches, T.DoubleType())(statistic, df1, df2)


def benjamini_hochberg(tests: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Adjusted p-values across the masses of a deployment; a null p-value is no test and stays null."""
    by = Window.partitionBy(*keys)
    rank = F.row_number().over(by.orderBy(F.asc_nulls_last("p_value"), "mass"))
    m = F.count("p_value").over(by)
    raw = tests.withColumn("__raw", F.col("p_value") * m / rank)
    downward = by.orderBy(F.desc_nulls_last("p_value"), F.desc("mass")).rowsBetween(Window.unboundedPreceding, 0)
    adjusted = F.when(F.col("p_value").isNotNull(), F.least(F.min("__raw").over(downward), F.lit(1.0)))
    return raw.withColumn("p_adj", adjusted).drop("__raw")


def setpoint_spread_tests(tagged: DataFrame, value: str = "current", relative: bool = True) -> DataFrame:
    """Per mass: does the spread of successive differences depend on the setpoint?"""
    stat = brown_forsythe(successive_pairs(tagged, value, relative))
    df1 = (F.col("n_setpoints") - 1).cast("double")
    df2 = (F.col("n") - F.col("n_setpoints")).cast("double")
    return benjamini_hochberg(stat.withColumn("p_value", f_tail(F.col("statistic"), df1, df2)))


def _solve3(a: list[Column], g: list[Column]) -> list[Column]:
    """Symmetric 3x3 system in closed form; a = [a00, a01, a02, a11, a12, a22]."""
    a00, a01, a02, a11, a12, a22 = a
    c00, c01, c02 = a11 * a22 - a12 * a12, a02 * a12 - a01 * a22, a01 * a12 - a02 * a11
    c11, c12, c22 = a00 * a22 - a02 * a02, a01 * a02 - a00 * a12, a00 * a11 - a01 * a01
    det = a00 * c00 + a01 * c01 + a02 * c02
    return [
        safe_div(c00 * g[0] + c01 * g[1] + c02 * g[2], det),
        safe_div(c01 * g[0] + c11 * g[1] + c12 * g[2], det),
        safe_div(c02 * g[0] + c12 * g[1] + c22 * g[2], det),
    ]


def fit_noise_model(holds: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """noise^2 = floor^2 + shot S + (prop S)^2 over holds, least squares of the logarithm, all terms >= 0.

    Damped Gauss-Newton on the logarithms of the parameters, so a term that the holds do not show goes towards 0. A pass is one
    aggregate per deployment over four damping values at once; the best goes on. It ends when no deployment's squared error
    falls by more than 1 in 10^10. Fewer than three holds: no row.
    """
    keys = list(keys)
    d = holds.where("current_raw_noise > 0 AND current_raw_mean > 0").select(
        *keys, F.col("current_raw_mean").alias("s"), F.col("current_raw_noise").alias("noise")
    )
    d = cut_lineage(d)
    start = d.groupBy(*keys).agg(F.min("noise").alias("m"), F.count(F.lit(1)).alias("n")).where("n >= 3")
    start = start.join(exact_median(d, keys, F.col("s"), "ms"), keys).join(exact_median(d, keys, F.col("noise") / F.col("s"), "mr"), keys)
    steps = start.select(
        *keys,
        F.array(F.struct((2 * F.ln("m")).alias("u0"), (2 * F.ln("m") - F.ln("ms")).alias("u1"), (2 * F.ln("mr")).alias("u2"))).alias("tries"),
    )
    best = None
    for _ in range(NOISE_ITERATIONS):
        trial = d.join(steps.select(*keys, F.explode("tries").alias("t")), keys).select(*keys, "s", "noise", "t.*")
        t0, t1, t2 = F.exp("u0"), F.exp("u1") * F.col("s"), F.exp("u2") * F.col("s") * F.col("s")
        total = t0 + t1 + t2
        j = [F.lit(0.5) * t / total for t in (t0, t1, t2)]
        e = F.ln("noise") - 0.5 * F.ln(total)
        sums = trial.groupBy(*keys, "u0", "u1", "u2").agg(
            F.sum(e * e).alias("sse"),
            *[F.sum(j[a] * j[b]).alias(f"a{a}{b}") for a, b in ((0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2))],
            *[F.sum(j[a] * e).alias(f"g{a}") for a in range(3)],
        )
        cols = ["sse", "u0", "u1", "u2", "a00", "a01", "a02", "a11", "a12", "a22", "g0", "g1", "g2"]
        pool = sums.select(*keys, *cols).where("sse IS NOT NULL AND NOT isnan(sse)")
        if best is not None:
            pool = pool.unionByName(best)
        before = best
        best = cut_lineage(pool.groupBy(*keys).agg(F.min(F.struct(*cols)).alias("b")).select(*keys, "b.*"))
        if before is not None:
            same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
            fell = before.alias("a").join(best.alias("b"), same).select((F.col("a.sse") - F.col("b.sse") - NOISE_TOLERANCE * F.col("a.sse")).alias("d"))
            if (fell.agg(F.max("d")).first()[0] or 0.0) <= 1e-20:
                break
        tries = []
        for damping in DAMPING:
            add = F.lit(damping)
            a = [F.col("a00") + add * F.col("a00") + 1e-12, F.col("a01"), F.col("a02"), F.col("a11") + add * F.col("a11") + 1e-12,
                 F.col("a12"), F.col("a22") + add * F.col("a22") + 1e-12]
            move = [F.greatest(F.least(m, F.lit(4.0)), F.lit(-4.0)) for m in _solve3(a, [F.col("g0"), F.col("g1"), F.col("g2")])]
            tries.append(F.struct(*[(F.col(f"u{i}") + F.coalesce(m, F.lit(0.0))).alias(f"u{i}") for i, m in enumerate(move)]))
        steps = best.select(*keys, F.array(*tries).alias("tries"))
    return best.select(*keys, F.exp(F.col("u0") / 2).alias("floor"), F.exp("u1").alias("shot"), F.exp(F.col("u2") / 2).alias("prop"), "sse")
