import math
import random

import pytest
from pyspark.sql import functions as F

from abyssal.functions.exact import READINGS, exact_avg, exact_sum
from abyssal.operators.aggregate import aggregate_onto_windows
from abyssal.operators.fluxes import compute_fluxes
from abyssal.operators.stats import line_fit

from .helpers import at


def shuffled(df, seed):
    return df.repartition(seed % 7 + 1, F.rand(seed)).sortWithinPartitions(F.rand(seed + 1))


def test_sums_do_not_depend_on_the_order(spark):
    rng = random.Random(1)
    rows = [(i % 3, rng.choice([1e-8, 1.0, 3e5]) * rng.uniform(-1, 1)) for i in range(5000)]
    df = spark.createDataFrame(rows, "k int, v double")
    found = {tuple(map(tuple, shuffled(df, s).groupBy("k").agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).orderBy("k").collect())) for s in range(6)}
    assert len(found) == 1
    for k, s, a in found.pop():
        values = [v for kk, v in rows if kk == k]
        assert math.isclose(s, math.fsum(values), rel_tol=1e-15) and math.isclose(a, math.fsum(values) / len(values), rel_tol=1e-15)


def test_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, 1.0), (2, None), (3, inf), (3, 1.0), (4, inf), (4, -inf), (5, nan), (6, 0.1), (6, 0.2)]
    got = {r.k: (r.s, r.a) for r in spark.createDataFrame(rows, "k int, v double").groupBy("k").agg(exact_sum("v").alias("s"), exact_avg("v", units=READINGS).alias("a")).collect()}
    assert got[1] == (None, None) and got[2] == (1.0, 1.0) and got[3] == (inf, inf) and math.isnan(got[4][0]) and math.isnan(got[5][0])
    assert math.isclose(got[6][0], 0.3) and math.isclose(got[6][1], 0.15, abs_tol=1e-12)


@pytest.mark.parametrize("scale,offset", [(1.0, 0.0), (1e-9, 0.0), (1e6, 1e7), (1e-3, 10.0)])
def test_line_fit(spark, scale, offset):
    rng = random.Random(2)
    rows = [(k, float(i), offset + scale * (k * i + rng.uniform(-1, 1))) for k in (1, 2) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, x double, y double")
    found = {tuple(map(tuple, line_fit(shuffled(df, s), ["k"], F.col("x"), F.col("y"), F.max("x").alias("top")).orderBy("k").collect())) for s in range(5)}
    assert len(found) == 1
    for k, slope, intercept, r2, n, top in found.pop():
        x, y = zip(*[(x, y) for kk, x, y in rows if kk == k])
        mx, my = math.fsum(x) / 40, math.fsum(y) / 40
        sxx, syy = math.fsum((a - mx) ** 2 for a in x), math.fsum((b - my) ** 2 for b in y)
        sxy = math.fsum((a - mx) * (b - my) for a, b in zip(x, y))
        assert (n, top) == (40, 39.0) and math.isclose(slope, sxy / sxx, rel_tol=1e-7) and math.isclose(r2, sxy**2 / sxx / syy, rel_tol=1e-7)
        assert math.isclose(intercept, my - sxy / sxx * mx, rel_tol=1e-7, abs_tol=1e-9 * scale)


def test_lines_without_a_slope(spark):
    rows = [("flat", 1.0, 0.1), ("flat", 2.0, 0.1), ("flat", 7.0, 0.1), ("one", 1.0, 2.0), ("upright", 1.0, 2.0), ("upright", 1.0, 3.0), ("gap", 1.0, None), ("gap", None, 1.0)]
    got = line_fit(spark.createDataFrame(rows, "k string, x double, y double"), ["k"], F.col("x"), F.col("y")).collect()
    assert [tuple(r) for r in got] == [("flat", 0.0, 0.1, 1.0, 3)]


def test_fluxes_have_equal_bits_however_rows_are_dealt(spark):
    rng = random.Random(3)
    windows = spark.createDataFrame([("d", at(600 * i), at(600 * i + 500), "C1", 1, 600_000_000 * i) for i in range(6)],
                                    "deployment_id string, window_start timestamp_ntz, window_end timestamp_ntz, chamber string, experiment_number bigint, elapsed_us bigint")
    sonde = spark.createDataFrame([("d", at(rng.uniform(0, 3600)), 10 + rng.random(), 35.0, 1013 * rng.random(), 8 - rng.random(), 8.0 + rng.random()) for _ in range(900)],
                                  "deployment_id string, ts timestamp_ntz, temp_degc double, sal_psu double, pressure_mbar double, oxygen_mgl double, ph double")
    rga = spark.createDataFrame([("d", at(rng.uniform(0, 3600)), m, rng.uniform(1e3, 1e6)) for _ in range(300) for m in (28, 40)], "deployment_id string, ts timestamp_ntz, mass bigint, current double")
    found = set()
    for seed in range(4):
        cycles = aggregate_onto_windows(shuffled(windows, seed), {"scalup": shuffled(sonde, seed), "rga": shuffled(rga, seed)}, [28, 40])
        found.add(tuple(sorted(map(repr, compute_fluxes(cycles).collect()))))
    assert len(found) == 1 and len(next(iter(found))) == 4
