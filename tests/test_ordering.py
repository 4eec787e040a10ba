import random

import pytest
from pyspark.sql import functions as F

from abyssal.operators import stats
from abyssal.operators.asof import asof_join, match_to_windows
from abyssal.operators.greedy import HoldRule, RepeatRule, greedy_segments
from abyssal.operators.stats import exact_median
from abyssal.ordering import ordered_scan, slice_width
from tests.helpers import at


def test_ordered_scan_crosses_chunks(spark):
    rng = random.Random(1)
    rows = [(k, i // 4, i, rng.choice([None, 1, 2, 3])) for k in "ab" for i in range(40)]
    df = spark.createDataFrame(rows, "key STRING, chunk BIGINT, pos BIGINT, v BIGINT")
    out = ordered_scan(df, ["key"], ["chunk"], ["pos"], prev={"p": F.col("v")}, following={"f": F.col("v")}, total={"t": F.col("v")})
    got = {(r.key, r.pos): (r.p, r.f, r.t) for r in out.collect()}
    assert len(got) == len(rows)
    for key in "ab":
        seq = [r[3] for r in rows if r[0] == key]
        for i in range(40):
            before = [v for v in seq[:i] if v is not None]
            after = [v for v in seq[i + 1:] if v is not None]
            want = (before[-1] if before else None, after[0] if after else None, sum(v or 0 for v in seq[: i + 1]))
            assert got[(key, i)] == want


def test_slice_width_follows_the_densest_minute(spark):
    rows = [("a", at(i * 0.01)) for i in range(6000)] + [("b", at(86400 * 3))]
    df = spark.createDataFrame(rows, "k STRING, ts TIMESTAMP_NTZ")
    assert slice_width(df, ["k"], rows=1000) == 60_000_000 * 1000 // 6000
    assert slice_width(df.limit(0), ["k"]) == 30 * 86_400_000_000


@pytest.mark.parametrize("seed", [1, 2])
def test_scans_split_where_a_mass_repeats(spark, seed):
    rng = random.Random(seed)
    rows, want = [], {}
    for key in ("a", "b", "c"):
        cycle = [2, 15, 18, 28, 40][: rng.randint(2, 5)]
        seq = [m for _ in range(25) for m in cycle if rng.random() > 0.2] + [rng.choice(cycle) for _ in range(20)]
        size = rng.randint(1, 7)
        scan, seen = 0, set()
        for i, m in enumerate(seq):
            if m in seen:
                scan, seen = scan + 1, set()
            seen.add(m)
            want[(key, i)] = scan
            rows.append((key, i // size, i, m))
    df = spark.createDataFrame(rows, "key STRING, chunk BIGINT, pos BIGINT, mass BIGINT")
    got = greedy_segments(df, ["key"], "chunk", ["pos"], ["mass"], RepeatRule()).collect()
    assert {(r.key, r.pos): r.segment for r in got} == want
    starts = {(r.key, r.segment) for r in got if r.is_start}
    assert starts == {(k, s) for (k, _), s in want.items()}


def test_repeats_compare_with_the_last_kept_row(spark):
    rng = random.Random(3)
    rows, want = [], []
    t, kept = 0, None
    for i in range(120):
        t += rng.choice([10, 40, 90, 130])
        sp = rng.choice([1000, 1000, 1000, 1200])
        if kept is None or kept[0] != sp or t - kept[1] > 120:
            kept = (sp, t)
            want.append(i)
        rows.append(("a", i // 5, i, sp, t))
    df = spark.createDataFrame(rows, "key STRING, chunk BIGINT, pos BIGINT, sp BIGINT, t BIGINT")
    got = greedy_segments(df, ["key"], "chunk", ["pos"], ["sp", "t"], HoldRule(120)).where("is_start").select("pos").collect()
    assert sorted(r[0] for r in got) == want


def _frames(spark, seed, n_left=80, n_right=25):
    rng = random.Random(seed)
    left = [("a" if rng.random() < 0.7 else "b", at(rng.randint(0, 300)), i) for i in range(n_left)]
    right = [(rng.choice("ab"), at(rng.randint(0, 300)), i) for i in range(n_right)]
    return left, right, spark.createDataFrame(left, "k STRING, ts TIMESTAMP_NTZ, id BIGINT"), spark.createDataFrame(right, "k STRING, ts TIMESTAMP_NTZ, v BIGINT")


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
def test_asof_against_brute_force(spark, direction):
    left, right, l, r = _frames(spark, 5)
    r = r.withColumnRenamed("ts", "rts").withColumn("o", F.col("v"))
    out = asof_join(l, r, ["k"], ["v"], right_ts="rts", direction=direction, right_order="o", width_us=20_000_000)
    got = {row.id: row.v for row in out.collect()}
    for k, ts, i in left:
        mine = [(t, v) for kk, t, v in right if kk == k]
        back = max(((t, v) for t, v in mine if t <= ts), default=None)
        ahead = min(((t, v) for t, v in mine if t >= ts), default=None)
        if direction == "backward":
            want = back
        elif direction == "forward":
            want = ahead
        elif back and ahead:
            want = back if ts - back[0] <= ahead[0] - ts else ahead
        else:
            want = back or ahead
        assert got[i] == (want[1] if want else None)


@pytest.mark.parametrize("strategy", ["carry", "broadcast"])
def test_windows_overlapping_duplicate_and_negative(spark, strategy):
    rng = random.Random(9)
    readings = [("a", at(rng.randint(0, 400)), i) for i in range(200)]
    windows = [("a", at(s), at(s + rng.randint(-20, 60)), i) for i, s in enumerate(rng.randint(0, 350) for _ in range(30))]
    r = spark.createDataFrame(readings, "deployment_id STRING, ts TIMESTAMP_NTZ, id BIGINT")
    w = spark.createDataFrame(windows, "deployment_id STRING, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, wid BIGINT")
    got = {x.id: x.wid for x in match_to_windows(r, w, order="wid", strategy=strategy, bucket_us=30_000_000, width_us=25_000_000).collect()}
    want = {}
    for _, ts, i in readings:
        before = [(s, wid, e) for _, s, e, wid in windows if s <= ts]
        if before and ts < max(before)[2]:
            want[i] = max(before)[1]
    assert got == want


def test_half_open_window_edge(spark):
    r = spark.createDataFrame([("d", at(0)), ("d", at(9.999)), ("d", at(10))], "deployment_id STRING, ts TIMESTAMP_NTZ")
    w = spark.createDataFrame([("d", at(0), at(10))], "deployment_id STRING, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ")
    for strategy in ("carry", "broadcast"):
        assert match_to_windows(r, w, strategy=strategy).count() == 2


def test_exact_median(spark):
    rng = random.Random(4)
    rows = []
    for key, n in (("a", 101), ("b", 100), ("c", 1), ("d", 2)):
        rows += [(key, rng.choice([0.0, -1.5, rng.gauss(0, 1e-12), rng.gauss(5, 100)])) for _ in range(n)]
    rows += [("e", 7.0)] * 50 + [("a", None), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE")
    import statistics

    got = {r.k: r.median for r in exact_median(df, ["k"], F.col("v")).collect()}
    for key in "abcde":
        real = [v for k, v in rows if k == key and v is not None and v == v]
        assert got[key] == pytest.approx(statistics.median(real), rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("few", [stats.FEW_GROUPS, 0])
def test_a_median_sends_no_rows_to_the_driver(spark, tmp_path, monkeypatch, few):
    """Repeated values are a few kB on disk and a hundred MB in memory; only the places of the middle ranks may be broadcast."""
    monkeypatch.setattr(stats, "FEW_GROUPS", few)
    name = F.concat(F.lit("a file of a long name, " * 5), (F.col("id") % 3).cast("string"))
    spark.range(600_000).select(name.alias("k"), (F.col("id") % 7).cast("double").alias("v")).repartition(2, "k").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxBroadcastTableSize", str(64 << 20))
    try:
        got = exact_median(df, ["k"], F.col("v")).collect()
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert len(got) == 3 and {r.median for r in got} == {3.0}


def _greedy(rows, conflicts):
    """Starts by a plain loop: a row starts a segment when it conflicts with the rows of the open one."""
    starts, open_rows = [], []
    for r in rows:
        if not open_rows or conflicts(open_rows, r):
            starts.append(True)
            open_rows = [r]
        else:
            starts.append(False)
            open_rows.append(r)
    return starts


@pytest.mark.parametrize("seed", range(4))
def test_summaries_compose_in_rounds(spark, monkeypatch, seed):
    """Chunks of one to four rows, two at a time: segments run through many chunks and levels."""
    from abyssal.operators import greedy

    monkeypatch.setattr(greedy, "FAN", 2)
    rng = random.Random(seed)
    masses = [("k", i // rng.choice([1, 2, 4]), i, rng.choice([2, 18, 28, 32, 40, 44, 45, 46][: 3 + seed])) for i in range(90)]
    masses = [(k, min(c for kk, c, j, _ in masses if j >= i), i, m) for k, c, i, m in masses]  # chunks in order
    got = greedy_segments(spark.createDataFrame(masses, "key string, chunk bigint, pos bigint, mass bigint"), ["key"], "chunk", ["pos"], ["mass"], RepeatRule()).orderBy("pos").collect()
    want = _greedy([m for *_, m in masses], lambda seen, m: m in seen)
    assert [r.is_start for r in got] == want and [r.segment for r in got] == [sum(want[:i + 1]) - 1 for i in range(len(want))]

    t, holds = 0, []
    for i in range(120):
        t += rng.choice([0, 1, 5, 30, 130])
        holds.append(("k", t // 20, i, rng.choice([800, 800, 800, 900]), t))
    df = spark.createDataFrame(holds, "key string, chunk bigint, pos bigint, sp bigint, t bigint")
    got = greedy_segments(df, ["key"], "chunk", ["t", "pos"], ["sp", "t"], HoldRule(120)).orderBy("pos").collect()
    assert [r.is_start for r in got] == _greedy([h[3:] for h in holds], lambda kept, r: r[0] != kept[0][0] or r[1] > kept[0][1] + 120)


@pytest.mark.parametrize("window", [10**9, 50_000, 7])
def test_one_setpoint_200_000_times(spark, window):
    n, per_chunk = 200_000, 10_000  # rows one microsecond apart
    df = spark.range(n).select(F.lit("k").alias("key"), F.floor(F.col("id") / per_chunk).alias("chunk"), F.col("id").alias("pos"), F.lit(800).cast("bigint").alias("sp"), F.col("id").alias("t"))
    got = greedy_segments(df, ["key"], "chunk", ["pos"], ["sp", "t"], HoldRule(window)).where("is_start")
    assert [r.pos for r in got.orderBy("pos").select("pos").collect()] == list(range(0, n, window + 1))


def test_only_positions_and_values_pass_through_python(spark):
    df = spark.createDataFrame([("k", 0, i, i % 3, "wide", 1.0) for i in range(9)], "key string, chunk bigint, pos bigint, mass bigint, text string, current double")
    rows = greedy_segments(df, ["key"], "chunk", ["pos"], ["mass"], RepeatRule())
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    python = [line for line in plan.splitlines() if "InPandas" in line]
    assert python and not any("text" in line or "current" in line for line in python)
    assert sorted(rows.columns) == sorted([*df.columns, "segment", "is_start"]) and rows.count() == 9
