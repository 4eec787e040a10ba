from datetime import datetime

from abyssal import standin
from abyssal.functions.text import iso_timestamp, nullable_number, strip
from abyssal.sources import loggers, logs
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def _deepest(plan, word):
    """Nesting of a word in the filters of a plan: how often filters repeat it."""
    return sum(line.count(word) for line in plan.splitlines() if "Filter" in line)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_picking_rows_by_tag_does_not_repeat_the_parsing(spark):
    spark.conf.set("spark.sql.maxPlanStringLength", "1000000")
    parsed = logs.parse_payload(standin.log_lines(spark, DATA))
    for tag in ("R", "V", "P", "!"):
        plan = _plan(parsed.where(F.col("tag") == tag).select("ts", "tag"))
        assert _deepest(plan, "split(") == 0 and _deepest(plan, "RLIKE") == 0, plan


def test_battery_lines_are_searched_once(spark):
    rows = logs.parse_events(standin.event_log_lines(spark, DATA))
    plan = _plan(rows.select("ts", "voltage_v", "current_a", "teensy_temp_c"))
    assert _deepest(plan, "format_string") == 0 and _deepest(plan, "regexp_extract") == 0, plan


def test_numbers_and_white_space_keep_their_rules(spark):
    texts = ["1", " 1_000.5 ", "1__0", "_1", "nan", "N/A", "", "-inf", "+Infinity", "1e3", "1e3d", ".5", "5.", "0x1F", " 7 ", "\u00858\x0b", "é9", None]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i INT, t STRING").select("i", nullable_number(F.col("t")).alias("n"), strip(F.col("t")).alias("s"))
    got = {r.i: (r.n, r.s) for r in df.collect()}
    inf = float("inf")
    assert [got[i][0] for i in range(len(texts))] == [1.0, 1000.5, None, None, None, None, None, -inf, inf, 1000.0, None, 0.5, 5.0, None, 7.0, 8.0, None, None]
    assert [got[i][1] for i in (1, 14, 15, 16, 6)] == ["1_000.5", "7", "8", "é9", ""]


def test_lines_of_every_kind(spark):
    t = "2024-01-01T00:00:01.123456789Z"
    lines = [f"R:{t},28.9, 5 ", f"R:{t},28,NA", f"V:{t},C1,Re", f"V:{t}, C1,Re", f"P:{t},x,1,2,8.5,7.9", f"P:{t},{t},1,2,3,4,5,6.7", f"!:{t},0,1,2,3,4,5,6,NULL,8,9", f"!:{t},boot,1", "R:,28,1", "PM:1"]
    df = spark.createDataFrame([("d", i, x, 0, i) for i, x in enumerate(lines)], "deployment_id STRING, i INT, payload STRING, chunk BIGINT, pos BIGINT")
    got = {r.i: r for r in logs.parse_payload(df).collect()}
    at = datetime(2024, 1, 1, 0, 0, 1, 123456)
    assert [got[i].tag for i in range(len(lines))] == ["R", None, "V", None, "P", "P", "!", "!", None, None]
    assert (got[0].ts, got[0].mass, got[0].current) == (at, 28, 5.0)
    assert (got[4].ts_scalup, got[4].temp_degc, got[4].sal_psu, got[4].pressure_mbar, got[4].oxygen_mgl, got[4].ph, got[4].field_mask) == (None, 1.0, 2.0, None, 8.5, 7.9, None)
    assert (got[5].ts_scalup, got[5].pressure_mbar, got[5].oxygen_mgl, got[5].ph, got[5].field_mask) == (at, 3.0, 4.0, 5.0, 6)
    assert (got[6].turbo_error, got[6].turbo_mtemp_c, got[6].rga_filament, got[6].pump_rpm, got[6].payload_raw) == (0.0, 6.0, None, 9.0, None)
    assert (got[7].turbo_error, got[7].payload_raw, got[7].ts) == (None, "boot,1", at)


def test_what_a_file_name_says_is_made_once_per_file(spark, tmp_path):
    folder = tmp_path / "raw" / "dep+1"
    folder.mkdir(parents=True)
    (folder / "gems_2024-01-01-00-00.txt").write_text("a\nb\n")
    (folder / "gems_2024-01-41-00-00.txt").write_text("c\n")
    (folder / "x.CSV").write_text("d\n")
    root = str(tmp_path / "raw")
    text, csv = logs.scan_text(spark, root, ("gems", "surface"), ["dep+1"]), loggers.scan_csv_text(spark, root, ["dep+1"])
    for df in (text, csv):
        assert "UrlCodec" not in _plan(df) and "gettimestamp" not in _plan(df), _plan(df)
    rows = sorted((r.deployment_id, r.file_name, r.line, r.chunk.split("|")[0], r.chunk[-16:]) for r in text.collect())
    assert rows == [("dep+1", "gems_2024-01-01-00-00.txt", c, "202401010000", "|000000000000000") for c in "ab"]
    assert [(r.deployment_id, r.file_name, r.line) for r in csv.collect()] == [("dep+1", "x.CSV", "d")]


def test_times_keep_their_rules(spark):
    texts = ["2024-01-01Z", "2024-01-01ZZ", " 2024-01-01 10:00Z ", "2024-01-01T10:00:01.", "2024-01-01T10:00:01.1234567Z", "2024-02-30", "2024-01-01T10:00:01.12345678Z9", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING").select("i", iso_timestamp(F.col("t")).alias("t"))
    got = {r.i: r.t for r in df.collect()}
    assert [got[i] for i in range(len(texts))] == [
        datetime(2024, 1, 1), None, datetime(2024, 1, 1, 10), None, datetime(2024, 1, 1, 10, 0, 1, 123456), None, None, None]
