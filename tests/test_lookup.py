"""As-of joins that leave the larger side where it is, or read it once less, give what carrying gives."""

import random

import pytest
from pyspark.sql import functions as F

from abyssal.functions.common import write_and_read
from abyssal.operators import asof
from abyssal.operators.setpoint import tag_readings
from abyssal.ordering import minute_counts, ordered_scan, sliced_chunks, time_slice, whole_minutes_width
from tests.helpers import at


def _sides(spark, rng):
    times = [rng.choice([rng.uniform(0, 40), rng.uniform(0, 400_000)]) for _ in range(60)]
    right = [(k, at(t), n, rng.choice([None, f"v{n}"])) for k in "abc" for n, t in enumerate(sorted(times))]
    right += [("a", right[7][1], 100 + i, f"tie{i}") for i in range(4)] + [("b", None, 0, "no time")]
    left = [(k, i, at(rng.uniform(-50_000, 450_000))) for i, k in enumerate("abcd" * 80)]
    left += [(k, 1000 + i, t) for i, (k, t, *_) in enumerate(right)] + [("a", 5000, None)]
    return (spark.createDataFrame(left, "k STRING, id BIGINT, ts TIMESTAMP_NTZ"),
            write_and_read(spark.createDataFrame(right, "k STRING, ts TIMESTAMP_NTZ, n BIGINT, v STRING")))


@pytest.mark.parametrize("most_buckets", [100_000, 10])
def test_lookup_is_the_backward_asof_join(spark, monkeypatch, most_buckets):
    monkeypatch.setattr(asof, "MOST_BUCKETS", most_buckets)
    left, right = _sides(spark, random.Random(5))
    r = right.withColumn("o", F.col("n"))
    want = asof.asof_join(left, r, ["k"], ["n", "v"], right_order="o", matched_ts="at")
    got = asof.asof_lookup(left, r, ["k"], ["n", "v"], right_order="o", matched_ts="at")
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_readings_stay_where_they_are_under_few_changes(spark):
    changes = write_and_read(spark.createDataFrame(
        [("d", at(10), 5, 0, "down", at(12), "ack"), ("d", at(500), 7, 1, "up", None, "command")],
        "deployment_id STRING, ts TIMESTAMP_NTZ, setpoint BIGINT, segment BIGINT, leg STRING, acq_on_ts TIMESTAMP_NTZ, source STRING"))
    readings = spark.createDataFrame([("d", at(t), t) for t in (5, 10, 100, 499, 500, 9000)], "deployment_id STRING, ts TIMESTAMP_NTZ, n BIGINT")
    out = tag_readings(readings, changes, 60.0)
    assert [(r.n, r.setpoint, r.in_settle) for r in out.orderBy("n").collect()] == [
        (10, 5, True), (100, 5, False), (499, 5, False), (500, 7, True), (9000, 7, False)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan


def test_rare_rows_carry_over_chunks_without_any(spark):
    rng = random.Random(2)
    rows = [(k, at(60 * i), i if rng.random() < 0.1 else None) for k in "ab" for i in range(300)]
    df = spark.createDataFrame(rows, "k STRING, ts TIMESTAMP_NTZ, v BIGINT")
    minutes = minute_counts(df, ["k"])
    width = whole_minutes_width(minutes, 7)
    assert width == 7 * 60_000_000
    sliced = df.withColumn("s", time_slice(F.unix_micros(F.col("ts").cast("timestamp")), width))
    ops = dict(prev={"p": F.col("v")}, following={"f": F.col("v")}, total={"t": F.col("v")})
    want = sorted(map(repr, ordered_scan(sliced, ["k"], ["s"], ["ts"], **ops).collect()))
    for chunks in (None, sliced_chunks(minutes, ["k"], "s", width)):
        got = ordered_scan(sliced, ["k"], ["s"], ["ts"], **ops, rare=F.col("v").isNotNull(), chunks=chunks)
        assert sorted(map(repr, got.collect())) == want


@pytest.mark.parametrize("rows_per_slice", [500_000, 3])
def test_differences_do_not_depend_on_how_groups_are_cut(spark, monkeypatch, rows_per_slice):
    from abyssal.operators import setpoint

    monkeypatch.setattr(setpoint, "ROWS_PER_SLICE", rows_per_slice)
    rng = random.Random(8)
    rows = [("d", s, at(60 * i), i // 5, i, rng.choice([None, 1.0, 2.5, 7.0])) for s in range(3) for i in range(40)]
    df = spark.createDataFrame(rows, "deployment_id STRING, segment BIGINT, ts TIMESTAMP_NTZ, chunk BIGINT, pos BIGINT, v DOUBLE")
    got = {(r.segment, r.pos): (r.diff, r.i) for r in setpoint.with_differences(df, "v", ["deployment_id", "segment"], number_rows=True).collect()}
    want = {}
    for s in range(3):
        last = None
        for _, seg, _, _, i, v in [r for r in rows if r[1] == s]:
            want[(seg, i)] = (None if v is None or last is None else v - last, i)
            last = last if v is None else v
    assert got == want
    plan = setpoint.with_differences(df, "v", ["deployment_id", "segment"])._jdf.queryExecution().executedPlan().toString()
    assert ("SortAggregate" in plan) == (rows_per_slice == 3)


def test_scan_ratio_reads_its_rows_once(spark):
    from abyssal.operators.ratios import scan_ratio

    rows = [("d", 0, 40, 2.0), ("d", 0, 28, 3.0), ("d", 1, 28, 5.0), ("d", 2, 40, 0.0), ("d", 2, 28, 5.0), ("e", 0, 40, 4.0), ("e", 0, 28, 2.0)]
    df = write_and_read(spark.createDataFrame(rows, "deployment_id STRING, scan_id BIGINT, mass BIGINT, current DOUBLE"))
    out = scan_ratio(df, 40, ["deployment_id", "scan_id"])
    assert out.columns == [*df.columns, "ratio"]
    assert sorted((r.deployment_id, r.scan_id, r.ratio) for r in out.where("mass = 28").collect()) == [
        ("d", 0, 1.5), ("d", 1, None), ("d", 2, None), ("e", 0, 0.5)]
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_analysis_writes_only_what_the_named_tables_need(spark, monkeypatch):
    from abyssal.operators import setpoint

    changes = spark.createDataFrame([("d", at(0), 5, "ack", None), ("d", at(900), 7, "ack", None)],
                                    "deployment_id STRING, ts TIMESTAMP_NTZ, setpoint BIGINT, source STRING, acq_on_ts TIMESTAMP_NTZ")
    rng = random.Random(4)
    rga = spark.createDataFrame([("d", at(10 * i), (28, 40)[i % 2], rng.uniform(1, 9), 0, i) for i in range(180)],
                                "deployment_id STRING, ts TIMESTAMP_NTZ, mass BIGINT, current DOUBLE, chunk BIGINT, pos BIGINT")
    status = spark.createDataFrame([("d", at(5), 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)], "deployment_id STRING, ts TIMESTAMP_NTZ, turbo_speed_hz DOUBLE, "
                                   "turbo_power_w DOUBLE, turbo_etemp_c DOUBLE, turbo_btemp_c DOUBLE, turbo_mtemp_c DOUBLE, raw_total_pressure_current DOUBLE")
    telemetry = spark.createDataFrame([], "deployment_id STRING, ts TIMESTAMP_NTZ, " + ", ".join(f"{c} DOUBLE" for c in setpoint.TELEMETRY.values()))
    whole = setpoint.analyze(rga, status, telemetry, changes, 60.0)
    monkeypatch.setattr(setpoint, "add_ratio", lambda *a: pytest.fail("no ratio was asked for"))
    one = setpoint.analyze(rga, status, telemetry, changes, 60.0, only=["mass_stats_by_speed"])
    assert [*one] == ["mass_stats_by_speed"] and len(whole) == 13
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(one["mass_stats_by_speed"]) == rows(whole["mass_stats_by_speed"]) and one["mass_stats_by_speed"].count() == 4


def test_view_of_readings_labels_transitions_once(spark, monkeypatch):
    from abyssal.operators import cycles
    from abyssal.plans import views
    from tests.helpers import rga, valve

    switches = valve(spark, [(0, "C1", "Re"), (300, "C2", "Re"), (600, "C1", "Fl"), (900, "C1", "Re")])
    readings = rga(spark, [(t, (40, 28)[t // 10 % 2], t + 1) for t in range(0, 600, 10)])
    other = "deployment_id STRING, ts TIMESTAMP_NTZ, {}"
    sonde = spark.createDataFrame([], other.format(", ".join(f"{c} DOUBLE" for c in views.SONDE.values())))
    status = spark.createDataFrame([], other.format(", ".join(f"{c} DOUBLE" for c in [*views.STATUS.values(), "raw_total_pressure_current"])))
    labelled = []
    label = cycles.label_experiments
    monkeypatch.setattr(cycles, "label_experiments", lambda *a: labelled.append(1) or label(*a))
    out = views.experiment_readings({"valve": switches, "rga": readings, "scalup": sonde, "status": status})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(labelled) == 1 and "flush_state" not in plan
    assert out.count() == 30
