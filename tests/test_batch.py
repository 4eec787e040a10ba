from datetime import datetime

import pytest
from pyspark.sql import functions as F

from abyssal.operators.asof import match_to_windows
from abyssal.plans.batch import RegistryError, run_batch
from abyssal.schemas import CALIBRATION_SCHEMA, DEPLOYMENT_SCHEMA
from abyssal.sources import logs, tables
from tests.helpers import at
from tests.test_windows import LOG


def deployments(spark, ids, **other):
    rows = [(i, "s", 1.0, 2.0, datetime(2025, 1, 1), None, False, "grass", other.get("c2", "sediment"), None, f"raw/{n}") for n, i in enumerate(ids)]
    return spark.createDataFrame(rows, DEPLOYMENT_SCHEMA + ", path STRING")


def run(spark, root, out, ids, fmt="parquet", **other):
    given = spark.createDataFrame([(i, "settle_offset_s", 0.0) for i in ids], "deployment_id STRING, key STRING, value DOUBLE")
    return run_batch(spark, str(root), str(out), deployments(spark, ids, **other), given, spark.createDataFrame([], CALIBRATION_SCHEMA), fmt=fmt)


def archive(tmp_path, folders):
    for f in folders:
        (tmp_path / "raw" / f).mkdir(parents=True)
        (tmp_path / "raw" / f / "gems_2026-01-01-00-00.txt").write_text(LOG)
    return tmp_path / "raw"


def test_log_only_archive_then_other_format(spark, tmp_path):
    ids = ["0012", "2026-08-29", "dep+1"]
    root, out = archive(tmp_path, ["north/0012", "2026-08-29", "dep+1"]), tmp_path / "out"
    got = {(r.deployment_id, r.measure): r.value for r in run(spark, root, out, ids).collect()}
    assert all(got[i, "n_chamber_cycles"] == 2 and got[i, "n_rga"] == 9 and got[i, "total_cycles"] == 2 for i in ids)
    for name in ("par", "hobo_oxygen", "system_health", "pi_fit"):
        assert tables.load_table(spark, str(out), name).count() == 0
    cycles = tables.load_table(spark, str(out), "chamber_cycles")
    assert dict(cycles.dtypes)["deployment_id"] == "string" and sorted(r[0] for r in cycles.select("deployment_id").distinct().collect()) == sorted(ids)
    # one deployment again, as CSV: its rows move, the others stay
    run(spark, root, out, ids[:1], fmt="csv")
    again = tables.load_table(spark, str(out), "chamber_cycles")
    assert again.count() == 6 and again.where("mass_18_avg = 50").count() == 3
    # what the first run wrote of it goes, and nothing changes for a reader
    gone = tables.vacuum(spark, str(out))
    assert gone and all("deployment_id=0012" in p and ".parquet" in p for p in gone) and tables.vacuum(spark, str(out)) == []
    assert tables.load_table(spark, str(out), "chamber_cycles").count() == 6


@pytest.mark.parametrize("fmt", ["parquet", "csv", "both"])
def test_a_run_counts_from_its_commit(spark, tmp_path, fmt):
    out = str(tmp_path / "out")

    def write(number, ids, fmt):
        run = tables.new_run()
        df = spark.createDataFrame([(i, number) for i in ids], "deployment_id STRING, number INT")
        tables.write_table(df, out, "rga", fmt, run)
        return run, df

    def read():
        return sorted(map(tuple, tables.load_table(spark, out, "rga").select("deployment_id", "number").collect()))

    first, df = write(1, ["01", "a b", "c=/d"], "parquet")
    assert tables.commit(spark, out, first, df) == 1
    second, df = write(2, ["a b"], fmt)  # stopped here, the earlier output is all there
    assert read() == [("01", 1), ("a b", 1), ("c=/d", 1)]
    assert tables.commit(spark, out, second, df, fmt) == 2
    assert read() == [("01", 1), ("a b", 2), ("c=/d", 1)]
    # a run over a deployment that has no rows any more empties it
    third, _ = write(3, [], "parquet")
    tables.commit(spark, out, third, spark.createDataFrame([("01",)], "deployment_id STRING"))
    assert read() == [("a b", 2), ("c=/d", 1)]
    assert tables.load_table(spark, out, "fluxes") is None


def test_two_runs_take_two_numbers(spark, tmp_path, monkeypatch):
    """Both saw the same last commit; the one that comes later takes the next number."""
    out, df = str(tmp_path / "out"), spark.createDataFrame([("a", 1)], "deployment_id STRING, number INT")
    runs = [tables.new_run(), tables.new_run()]
    for run in runs:
        tables.write_table(df, out, "rga", run=run)
    monkeypatch.setattr(tables, "commits", lambda *_: [])
    assert [tables.commit(spark, out, run, df) for run in runs] == [1, 2]
    monkeypatch.undo()
    assert [r for _, r, _ in tables.commits(spark, out)] == runs
    assert tables.current_runs(spark, out).first().run == runs[1]


def test_all_violations_are_reported_and_nothing_is_lost(spark, tmp_path):
    root, out = archive(tmp_path, ["a"]), tmp_path / "out"
    run(spark, root, out, ["a"])
    with pytest.raises(RegistryError, match="60 violations"):
        run(spark, root, out, [f"d{i}" for i in range(60)], c2="stones")
    assert spark.read.parquet(f"{out}/violations").count() == 60
    assert tables.load_table(spark, str(out), "chamber_cycles").count() == 2


def test_output_may_not_be_the_raw_root(spark, tmp_path):
    with pytest.raises(ValueError):
        run(spark, tmp_path, tmp_path, ["a"])


def test_folders_are_plain_text(spark):
    paths = [("file:///data/raw+x/dep%2B1/a.txt", "dep+1"), ("file:///data/raw+x/site/d%20e/a.txt", "site"), ("file:///data/raw+x/site/known/sub/a.txt", "known")]
    df = spark.createDataFrame(paths, "p STRING, want STRING")
    assert [r[0] for r in df.select(logs.deployment_of(F.col("p"), "/data/raw+x", ["known", "x"])).collect()] == [w for _, w in paths]


@pytest.mark.parametrize("turn", [1, -1])
def test_equal_starts_have_one_rule(spark, turn):
    w = [("d", at(0), at(0), 1), ("d", at(0), at(50), 2), ("d", at(100), at(180), 3), ("d", at(100), at(120), 4)][::turn]
    windows = spark.createDataFrame(w, "deployment_id STRING, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, w INT")
    readings = spark.createDataFrame([("d", at(t)) for t in (10, 60, 110, 150)], "deployment_id STRING, ts TIMESTAMP_NTZ")
    for strategy in ("carry", "broadcast"):
        got = match_to_windows(readings, windows, strategy=strategy)
        assert sorted((r.ts, r.w) for r in got.collect()) == [(at(10), 2), (at(110), 3), (at(150), 3)]
