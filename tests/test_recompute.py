import random

from pyspark.sql import functions as F

from abyssal.operators.aggregate import aggregate_onto_windows
from abyssal.operators.asof import match_to_windows
from abyssal.operators.intervals import elementary_intervals
from abyssal.plans import recompute

from .helpers import at, valve


def tables(spark, n=1500):
    rng = random.Random(5)
    turns = [(300 * i, *([("C1", "Re"), ("C2", "Re")] * 4 + [("C1", "Fl"), ("C2", "Fl")])[i % 10]) for i in range(40)]
    end = 300 * 40
    times = lambda k: sorted(rng.uniform(0, end) for _ in range(k))
    sonde = [("d", at(t), 10 + rng.random(), 35.0, 1000.0, 8 - t / 1e4 - rng.random() / 100, 8.1) for t in times(n)]
    rga = [("d", at(t), m, rng.uniform(1e3, 1e5)) for t in times(n) for m in (28, 40)]
    status = [("d", at(t), 1200.0, 50.0, 8000.0, rng.uniform(1e3, 1e4)) for t in times(n)]
    par = [("d", at(t), 100 * rng.random(), 30.0, 60.0) for t in times(n)]
    make = spark.createDataFrame
    return {
        "valve": valve(spark, turns), "rga": make(rga, "deployment_id string, ts timestamp_ntz, mass bigint, current double"),
        "scalup": make(sonde, "deployment_id string, ts timestamp_ntz, temp_degc double, sal_psu double, pressure_mbar double, oxygen_mgl double, ph double"),
        "status": make(status, "deployment_id string, ts timestamp_ntz, turbo_speed_hz double, turbo_power_w double, pump_rpm double, raw_total_pressure_current double"),
        "par": make(par, "deployment_id string, ts timestamp_ntz, par_umol_m2_s double, par_raw double, interval_s double"),
    }


def test_intervals_hold_every_instant_of_every_window_once(spark):
    rng = random.Random(6)
    rows = []
    for k in range(4):
        for _ in range(25):
            s = rng.randint(0, 400)
            rows.append(("d", k, at(s), at(s + rng.randint(-5, 60))))
    windows = spark.createDataFrame(rows, "deployment_id string, k int, window_start timestamp_ntz, window_end timestamp_ntz")
    cuts, members = elementary_intervals(windows, ["deployment_id"], "k")
    ticks = spark.createDataFrame([("d", at(i)) for i in range(470)], "deployment_id string, ts timestamp_ntz")
    inside = match_to_windows(ticks, cuts).withColumnRenamed("window_start", "cut_start").join(members, ["deployment_id", "cut_start"]).select("k", "window_start", "ts")
    want = match_to_windows(ticks.crossJoin(spark.range(4).select(F.col("id").cast("int").alias("k"))), windows, ["deployment_id", "k"]).select("k", "window_start", "ts")
    assert sorted(inside.collect()) == sorted(want.collect()) and inside.count() > 300


def test_grid_equals_one_set_at_a_time(spark):
    t = {n: df.persist() for n, df in tables(spark).items()}
    sets = [{"settle_offset_s": 45.5, "chamber_volume_l": 9.0}, {"settle_offset_s": 200.0}, {"settle_offset_s": 500.0}]
    got = recompute.recompute_grid(t, sets, [28, 40], fit=False)
    for name, order in (("chamber_cycles", ["timestamp"]), ("fluxes", ["experiment_number", "chamber", "variable"])):
        for i, s in enumerate(sets):
            parameters = recompute.with_parameter_sets(t["valve"].select("deployment_id").distinct(), [s]).drop("param_id")
            alone = recompute.layers_from_streams({n: t[n] for n in ("rga", "scalup", "status", "par")}, t["valve"], parameters, [28, 40], fit=False)[name]
            rows = got[name].where(F.col("param_id") == i).select(alone.columns).orderBy(order).collect()
            assert bool(rows) == (s["settle_offset_s"] < 300)
            if rows and i:
                assert rows == alone.orderBy(order).collect()


def test_readings_are_not_copied_per_set(spark):
    """As many readings leave the union of the streams for one set as for twenty."""
    t = tables(spark, 200)
    windows = aggregate_onto_windows.__globals__["all_readings"]  # the one place where streams are read
    seen = []

    def counted(streams, keys):
        out = windows(streams, keys)
        seen.append(out.count())
        return out

    aggregate_onto_windows.__globals__["all_readings"] = counted
    try:
        recompute.recompute_grid(t, [{}], [28, 40], fit=False)
        recompute.recompute_grid(t, [{"settle_offset_s": 10.0 * i} for i in range(20)], [28, 40], fit=False)
    finally:
        aggregate_onto_windows.__globals__["all_readings"] = windows
    assert seen == [1000, 1000]
