"""Instrument streams, dimension tables and a raw log archive derived from the `events` table.

One event gives one scan of six masses, one sonde, status, health, light and oxygen-logger record, and one
valve transition; eight deployments by user. Every table grows with `events`.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abyssal.functions.common import add_seconds, micros, shared_dir, use_utc
from abyssal.schemas import KEY

MASSES = (2, 18, 28, 32, 40, 44)
VALVE = {"view": ("C1", "Re"), "click": ("C2", "Re"), "purchase": ("C1", "Fl"), "signup": ("C2", "Fl"), "error": ("C1", "Unknown")}
EVENTS_PER_CHUNK = 8192
EVENTS_PER_TASK = 200_000
WINDOW_S, SETTLE_S = 120.0, 60.0


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with deployment, k, and an arrival order that swaps some neighbours (a clock jump)."""
    use_utc(spark)
    # `k` is read out of its text before rows are dealt, once per row.
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.col("ts").cast("timestamp_ntz"), "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    # One small file is one split, and a large one no more splits than row groups; the derived rows are many times larger, so events are
    # spread over the cores and over as many tasks as their number asks for (the files' footers hold it).
    tasks = max(spark.sparkContext.defaultParallelism, -(-e.count() // EVENTS_PER_TASK))
    if e.rdd.getNumPartitions() < tasks:
        e = e.repartition(tasks, "event_id")
    swap = (F.col("k") < 10).cast("bigint")
    return (
        e.withColumn("n", F.col("user_id") % 8)
        .withColumn(KEY, F.concat(F.lit("d"), F.col("n").cast("string")))
        .withColumn("arrival", F.col("event_id").bitwiseXOR(swap) * 2 + swap)
        .withColumn("chunk", F.floor(F.col("arrival") / (2 * EVENTS_PER_CHUNK)).cast("bigint"))
    )


def _later(seconds: float) -> Column:
    return add_seconds(F.col("ts"), seconds)


def rga(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan per event, five seconds between masses; some scans miss a mass, some argon readings are zero."""
    e = events(spark, sf_dir)
    j = F.col("j")
    mass = F.element_at(F.array(*[F.lit(m).cast("bigint") for m in MASSES]), j + 1)
    counts = F.floor(F.col("value") * 100).cast("double") * (j + 1) + F.col("k")
    rows = e.withColumn("j", F.explode(F.array(*[F.lit(i) for i in range(6)]))).where("k % 7 != j")
    return rows.select(
        KEY, add_seconds(F.col("ts"), j * 5.0).alias("ts"), mass.alias("mass"),
        F.when((mass == 40) & (F.col("k") == 50), F.lit(0.0)).otherwise(counts).alias("current"),
        "chunk", (F.col("arrival") * 8 + j).alias("pos"),
    )


def valve(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    chamber, flush = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, (c, f) in VALVE.items():
        chamber = F.when(F.col("event_type") == kind, c).otherwise(chamber)
        flush = F.when(F.col("event_type") == kind, f).otherwise(flush)
    return e.select(KEY, "ts", chamber.alias("chamber"), flush.alias("flush_state"), "chunk", F.col("arrival").alias("pos"))


def scalup(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, v = F.col("k"), F.col("value")
    return events(spark, sf_dir).select(
        KEY, _later(10).alias("ts"), F.col("ts").alias("ts_scalup"), (10 + k / 10).alias("temp_degc"), (30 + k / 50).alias("sal_psu"),
        (1000 + v).alias("pressure_mbar"), F.when(k % 25 != 0, v / 20).alias("oxygen_mgl"), (7.5 + k / 200).alias("ph"),
        F.lit(None).cast("bigint").alias("field_mask"), "chunk", F.col("arrival").alias("pos"),
    )


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return events(spark, sf_dir).select(
        KEY, _later(20).alias("ts"), F.when(k == 99, F.lit(1.0)).otherwise(F.lit(0.0)).alias("turbo_error"),
        (1100 + k * 2).cast("double").alias("turbo_speed_hz"), (50 + k / 10).alias("turbo_power_w"), F.lit(24.0).alias("turbo_voltage"),
        (30 + k / 10).alias("turbo_etemp_c"), (25 + k / 10).alias("turbo_btemp_c"), (24 + k / 10).alias("turbo_mtemp_c"),
        F.lit(1.0).alias("rga_filament"), F.floor(F.col("value") * 10).cast("double").alias("raw_total_pressure_current"),
        (8000 + k).cast("double").alias("pump_rpm"), F.lit(None).cast("string").alias("payload_raw"), "chunk", F.col("arrival").alias("pos"),
    )


def system_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return events(spark, sf_dir).select(
        KEY, _later(30).alias("ts"), (20 + k / 10).alias("voltage_v"), (k / 1000).alias("current_a"), (40 + k / 2).alias("teensy_temp_c"),
        "chunk", F.col("arrival").alias("pos"),
    )


def par_raw_value() -> Column:
    """Bright by day, near zero at night."""
    return F.when(F.hour("ts").between(6, 17), F.floor(F.col("value") * 20).cast("double")).otherwise((F.col("k") % 7).cast("double"))


def par(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = par_raw_value()
    lit = F.greatest(F.lit(0.0), raw * 0.5 - 2.0)
    return events(spark, sf_dir).select(
        KEY, _later(40).alias("ts"), F.col("event_id").alias("scan_no"), raw.alias("par_raw"),
        F.when(F.col("n") != 7, lit).alias("par_umol_m2_s"), F.lit("50472").alias("serial_number"), F.lit(1).cast("bigint").alias("sensor_number"),
        F.lit(None).cast("date").alias("cal_date"), F.lit(1800.0).alias("interval_s"),
    )


def hobo(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    place = F.element_at(F.array(*[F.lit(p) for p in ("C1", "C2", "mesocosm", "ambient")]), k % 4 + 1)
    return events(spark, sf_dir).select(
        KEY, _later(50).alias("ts"), place.alias("location"), (F.col("value") / 20).alias("oxygen_mgl"), (10 + k / 10).alias("temp_degc"),
        F.concat(F.lit("2011"), (k % 4).cast("string")).alias("serial_number"),
    )


STREAMS = {"rga": rga, "valve": valve, "scalup": scalup, "status": status, "system_health": system_health, "par": par, "hobo_oxygen": hobo}


def streams(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: STREAMS[n](spark, sf_dir) for n in names or STREAMS}


def deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per deployment; its window leaves out half a day at both ends, one has an open end."""
    n = F.col("n")
    vocabulary = F.array(*[F.lit(c) for c in ("grass", "sediment", "none")])
    rows = events(spark, sf_dir).groupBy(KEY, "n").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return rows.select(
        KEY, F.concat(F.lit("site"), (n % 3).cast("string")).alias("site"), (41.5 + n / 10).alias("lat"), (-70.5 - n / 10).alias("lon"),
        add_seconds(F.col("lo"), 43_200).alias("start"), F.when(n != 3, add_seconds(F.col("hi"), -43_200)).alias("end"),
        (n == 5).alias("test"), F.element_at(vocabulary, (n % 3 + 1).cast("int")).alias("c1"),
        F.element_at(vocabulary, ((n + 1) % 3 + 1).cast("int")).alias("c2"), F.lit(None).cast("string").alias("comments"),
        F.concat(F.lit("raw/"), F.col(KEY)).alias("path"),
    )


def given_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters some deployments state themselves."""
    n = F.col("n")
    rows = events(spark, sf_dir).select(KEY, "n").distinct()
    cells = F.array(
        F.when(n < 4, F.struct(F.lit("settle_offset_s").alias("key"), (30 + 10 * n).cast("double").alias("value"))),
        F.when(n.isin(2, 5), F.struct(F.lit("chamber_height_m").alias("key"), (0.1 + n / 100).alias("value"))),
        F.when(n == 6, F.struct(F.lit("chamber_volume_l").alias("key"), F.lit(28.0).alias("value"))),
        F.when(n == 1, F.struct(F.lit("n2_ar_sensitivity_ratio").alias("key"), F.lit(1.2).alias("value"))),
    )
    return rows.select(KEY, F.explode(cells).alias("c")).where("c IS NOT NULL").select(KEY, "c.key", "c.value")


def light_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Oxygen fluxes with experiment light that follow a saturating curve plus noise, one per event."""
    k = F.col("k")
    light = F.col("value") * 8
    return events(spark, sf_dir).select(
        KEY, F.col("event_id").alias("experiment_number"), F.when(k % 2 == 0, "C1").otherwise("C2").alias("chamber"),
        F.col("ts").alias("experiment_start"), F.lit("oxygen").alias("variable"), (k / 100).alias("r2"),
        (1500 * F.tanh(6 * light / 1500) - 200 + (k - 50) * 2).alias("output_value"),
        F.when(k != 13, light).alias("par_mean_umol_m2_s"), (light * 3.6e-3).alias("par_integrated_mol_m2"), (0.85 + k / 400).alias("par_coverage"),
    )


# --- control streams -------------------------------------------------------------------------------------


def control_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands seen up to three times, acknowledgements with and without digits, acquisition-on, telemetry."""
    e = events(spark, sf_dir).where("event_type IN ('click', 'signup')")
    k = F.col("k")
    setpoint = F.col("setpoint").cast("string")
    click = F.col("event_type") == "click"
    line = lambda ok, after, text: F.when(ok, F.struct(F.lit(float(after)).alias("after"), text.alias("payload")))
    ack = F.when(k % 5 == 0, F.lit("OK,SPD")).otherwise(F.concat(F.lit("OK,SPD"), setpoint))
    cells = F.array(
        line(click, 0, F.concat(F.lit("RX_CONSOLE SPD"), setpoint)),
        line(click, 3, F.concat(F.lit("TX_LANDER SPD"), setpoint)),
        line(click & (k % 2 == 0), 200, F.concat(F.lit("SPD"), setpoint, F.lit(" again"))),
        line(click & (k % 3 != 0), 5, ack),
        line(click & (k % 3 != 0), 60, ack),
        line(click & (k % 4 != 0), 30, F.lit("OK,AON")),
        line(~click, 1, F.concat(F.lit("TS,SPD="), (1200 + k).cast("string"), F.lit(",PWR="), (k % 9).cast("string"), F.lit(",TP="),
                                 F.when(k % 11 == 0, "bad").otherwise((k * 3).cast("string")))),
    )
    rows = e.withColumn("setpoint", 1000 + 100 * F.floor(k / 20)).select(KEY, "ts", "event_id", F.posexplode(cells).alias("i", "c"))
    ts = add_seconds(F.col("ts"), F.col("c.after"))
    return rows.where("c IS NOT NULL").select(
        KEY, ts.alias("ts"), F.col("c.payload").alias("payload"), F.lit("surface_2024-01-01-00-00_events.log").alias("file_name"),
        F.floor(F.col("event_id") / EVENTS_PER_CHUNK).cast("bigint").alias("chunk"), (F.col("event_id") * 8 + F.col("i")).alias("pos"),
    )


DETECTOR_EVENTS = {"view": "AON", "click": "AOFF", "purchase": "EMON", "signup": "EMOFF"}


def _clock(df: DataFrame, *extra: str) -> DataFrame:
    """Receipt time in whole seconds; arrival order is the order of the running receipt clock."""
    us = micros("ts")
    return df.select(
        KEY, F.date_trunc("second", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("receipt_ts"), "ts", *extra,
        F.floor(us / 86_400_000_000).cast("bigint").alias("chunk"), us.alias("pos"),
    )


def detector_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.lit(None).cast("string")
    for kind, event in DETECTOR_EVENTS.items():
        name = F.when(F.col("event_type") == kind, event).otherwise(name)
    return _clock(events(spark, sf_dir).withColumn("event", name).where("event IS NOT NULL"), "event").drop("ts")


def detector_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clock(rga(spark, sf_dir).withColumnRenamed("current", "counts"), "mass", "counts")


def detector_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clock(status(spark, sf_dir), "raw_total_pressure_current")


# --- log lines and the raw archive ------------------------------------------------------------------------


def stamp(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five lines per event (R, V, P, !, noise), some malformed, for the line parsers; `k` tells which."""
    e = events(spark, sf_dir).withColumn("t", stamp(F.col("ts")))
    k = F.col("k")
    text = lambda c: c.cast("string")
    n10 = k % 10
    r = (
        F.when(n10 == 3, F.concat(F.lit("R:"), "t", F.lit(",NA,"), text(k)))
        .when(n10 == 4, F.concat(F.lit("R:"), "t", F.lit(",28,1,2")))
        .when(n10 == 5, F.concat(F.lit("R:"), "t", F.lit(",28,1e3d")))
        .when(n10 == 6, F.concat(F.lit("R:2026-1-1T00:00:00Z,28,"), text(k)))
        .when(n10 == 7, F.concat(F.lit("R: "), "t", F.lit(" , 28.9 , "), text(k), F.lit(" ")))
        .otherwise(F.concat(F.lit("R:"), "t", F.lit(",28,"), text(k)))
    )
    v = (
        F.when(n10 == 3, F.concat(F.lit("V:"), "t", F.lit(",C3,Re")))
        .when(n10 == 4, F.concat(F.lit("V:"), "t", F.lit(",C1,Re,x")))
        .when(n10 == 5, F.concat(F.lit("V:"), "t", F.lit(", C1,Re")))
        .when(n10 == 6, F.concat(F.lit("V:"), "t", F.lit(",C2,Unknown")))
        .otherwise(F.concat(F.lit("V:"), "t", F.lit(",C1,Fl")))
    )
    head = F.concat(F.lit("P:"), "t", F.lit(","), "t", F.lit(","), text(10 + k / 10), F.lit(","), text(30 + k / 50), F.lit(","))
    p = (
        F.when(k % 4 == 0, F.concat(head, F.lit("8.5,7.9")))
        .when(k % 4 == 1, F.concat(head, F.lit("1010.5,8.5,7.9")))
        .when(k % 4 == 2, F.concat(head, F.lit("n/a,junk,7.9,"), text(k), F.lit(".7")))
        .otherwise(F.concat(head, F.lit("1,2,3,4,5")))
    )
    s = F.when(k % 3 == 0, F.concat(F.lit("!:"), "t", F.lit(",boot,"), text(k))).otherwise(
        F.concat(F.lit("!:"), "t", F.lit(",0,1200,50,2400,30,25,NULL,1,"), text(k), F.lit(",8760"))
    )
    noise = F.when(n10 < 5, F.concat(F.lit("PM:"), "t", F.lit(",1"))).otherwise(F.lit("TP,1,2,3"))
    rows = e.select(KEY, "event_id", "k", "ts", "chunk", "arrival", F.posexplode(F.array(r, v, p, s, noise)).alias("i", "payload"))
    return rows.select(KEY, "event_id", "k", F.col("ts").alias("event_ts"), "chunk", (F.col("arrival") * 8 + F.col("i")).alias("pos"), "i", "payload")


def wrapped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same payloads inside the surface envelope, with headers, one-token and blank lines."""
    rows = log_lines(spark, sf_dir)
    line = (
        F.when((F.col("i") == 4) & (F.col("k") % 3 == 0), F.lit("# surface-lander-log-v1"))
        .when((F.col("i") == 4) & (F.col("k") % 3 == 1), F.lit("onetoken"))
        .when(F.col("i") == 4, F.lit("  \t "))
        .otherwise(F.concat(F.lit(" "), stamp(F.col("event_ts")), F.lit("   "), "payload", F.lit(" ")))
    )
    return rows.select(
        KEY, "event_id", "i", F.lit("surface_2024-01-01-00-00_lander.log").alias("file_name"), "chunk", "pos",
        F.regexp_replace(line, r"(?U)^\s+|\s+$", "").alias("line"),
    )


def _event_log_text() -> Column:
    k = F.col("k")
    battery = F.concat(stamp(F.col("ts")), F.lit(" SYSTEM battery voltage="), F.format_string("%.2f", 20 + k / 10), F.lit("V current="),
                       F.format_string("%.3f", k / 1000), F.lit("A temp="), F.format_string("%.1f", 40 + k / 2), F.lit("C"))
    return (
        F.when(k % 5 == 0, F.concat(stamp(F.col("ts")), F.lit(" SYSTEM battery voltage below threshold")))
        .when(k % 5 == 1, F.concat(stamp(F.col("ts")), F.lit(" RX_CONSOLE VSTAT")))
        .otherwise(battery)
    )


def event_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(KEY, "event_id", "chunk", F.col("arrival").alias("pos"), _event_log_text().alias("line"))


def _week() -> Column:
    return F.date_format(F.date_trunc("week", F.col("ts").cast("timestamp")), "yyyy-MM-dd")


def _log_text() -> Column:
    """The lander-log lines of an event, in order; surface files repeat the receipt time before each."""
    k, t = F.col("k"), stamp(F.col("ts"))
    text = lambda c: c.cast("string")
    scan = [
        F.when(k % 7 != j, F.concat(F.lit("R:"), stamp(_later(5.0 * j)), F.lit(f",{m},"), text(F.floor(F.col("value") * 100) * (j + 1) + k)))
        for j, m in enumerate(MASSES)
    ]
    state = F.lit(None).cast("string")
    for kind, (c, f) in VALVE.items():
        state = F.when(F.col("event_type") == kind, f"{c},{f}").otherwise(state)
    v = F.concat(F.lit("V:"), t, F.lit(","), state)
    p = F.concat(F.lit("P:"), stamp(_later(10)), F.lit(","), t, F.lit(","), text(10 + k / 10), F.lit(","), text(30 + k / 50), F.lit(","),
                 text(1000 + F.col("value")), F.lit(","), F.when(k % 25 != 0, text(F.col("value") / 20)).otherwise("NA"), F.lit(","), text(7.5 + k / 200))
    s = F.concat(F.lit("!:"), stamp(_later(20)), F.lit(",0,"), text(1100 + k * 2), F.lit(","), text(50 + k / 10), F.lit(",24,30,25,24,1,"),
                 text(F.floor(F.col("value") * 10)), F.lit(","), text(8000 + k))
    lines = F.concat_ws("\n", v, *scan, p, s, F.lit("PM:noise"))
    before = F.concat(t, F.lit(" "))
    return F.when(F.col("event_type") == "error", F.concat(before, F.replace(lines, F.lit("\n"), F.concat(F.lit("\n"), before)))).otherwise(lines)


def _logs(e: DataFrame) -> DataFrame:
    surface = F.col("event_type") == "error"
    file = F.when(surface, F.concat(F.lit("surface_"), _week(), F.lit("-00-00_lander.log"))).otherwise(F.concat(F.lit("gems_"), _week(), F.lit("-00-00.txt")))
    return _filed(e.withColumn("file", file), _log_text())


def _event_logs(e: DataFrame) -> DataFrame:
    return _filed(e.withColumn("file", F.concat(F.lit("surface_"), _week(), F.lit("-00-00_events.log"))), _event_log_text())


def _exports(e: DataFrame) -> DataFrame:
    """Light and oxygen logger exports, and a CSV file of neither kind."""
    k = F.col("k")
    text = lambda c: c.cast("string")
    par_file = F.concat(F.lit("PAR-"), KEY, F.lit(".CSV"))
    par_text = F.when(k == 77, F.lit("garbled")).otherwise(F.concat(text(F.col("event_id")), F.lit(","), F.date_format("ts", "dd/MM/yyyy"), F.lit(" , "),
                                                                     F.date_format("ts", "HH:mm:ss"), F.lit(","), text(par_raw_value()), F.lit(",0")))
    par_head = ["\ufeffSite Name ,harbour", "Logger ,Integrating Light Sensor", "Logger Serial Number ,#", "", "Scan No ,Date and Time,x", " , ,RAW VALUE ,CALIBRATED VALUE,"]
    place = F.element_at(F.array(*[F.lit(x) for x in ("C1", "C2", "mesocosm", "pond_1")]), k % 4 + 1)
    hobo_file = F.concat(F.lit("hobo_"), F.col("place"), F.lit(".csv"))
    local = F.date_format(add_seconds(F.col("ts"), -4 * 3600), "MM/dd/yy hh:mm:ss a")
    hobo_text = (
        F.when(k % 20 == 19, F.concat(text(F.col("event_id")), F.lit(","), local, F.lit(",-888.88,-888.88,,")))
        .when(k % 20 == 18, F.concat(text(F.col("event_id")), F.lit(","), local, F.lit(",,,Logged,")))
        .otherwise(F.concat(text(F.col("event_id")), F.lit(","), local, F.lit(","), text(F.col("value") / 20), F.lit(","), text(50 + k), F.lit(",,")))
    )
    hobo_head = F.concat(
        F.lit('\ufeff"Plot Title: '), "place",
        F.lit('"\n"#","Date Time, GMT-04:00","DO conc, mg/L (LGR S/N: 20113801, SEN S/N: 20113801)","Temp, °F (LGR S/N: 20113801)","Stopped","End"'))
    serial = F.when(F.col("n") == 7, "11111").otherwise("50472")
    dep = e.select(KEY, "n").distinct()
    first = F.lit(-1).cast("bigint").alias("event_id")
    heads = dep.select(KEY, par_file.alias("file"), first, F.replace(F.lit("\n".join(par_head)), F.lit("#"), serial).alias("head"))
    places = e.select(KEY, place.alias("place")).distinct().select(KEY, hobo_file.alias("file"), first, hobo_head.alias("head"))
    other = dep.select(KEY, F.lit("gems_pump_2024-01-01.csv").alias("file"), first, F.lit("ts,rpm").alias("head"))
    rows = e.withColumn("file", F.explode(F.array(par_file, F.concat(F.lit("hobo_"), place, F.lit(".csv")))))
    for part in (heads, places, other):
        rows = rows.unionByName(part, allowMissingColumns=True)
    return _filed(rows, F.coalesce("head", F.when(F.col("file").startswith("PAR-"), par_text).otherwise(hobo_text)))


def _filed(rows: DataFrame, text: Column) -> DataFrame:
    """(deployment, file, text) in the order of each file; an event's lines are one text.

    Only the events' own few columns are dealt and sorted; the text, many times larger, is made when it is written. Names are not
    null, so that the writer takes this order as its own and does not sort again.
    """
    named = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in (KEY, "file")})
    keep = [c for c in (KEY, "file", "event_id", "ts", "event_type", "value", "k", "head") if c in named.columns]
    return named.select(*keep).repartition(KEY, "file").sortWithinPartitions(KEY, "file", "event_id").select(KEY, "file", text.alias("text"))


ARCHIVE = {"logs": _logs, "event_logs": _event_logs, "exports": _exports}


@lru_cache(maxsize=8)
def _root(app_id: str, sf_dir: str) -> str:
    return shared_dir(SparkSession.getActiveSession())


@lru_cache(maxsize=24)
def _archived(app_id: str, sf_dir: str, kind: str) -> None:
    spark = SparkSession.getActiveSession()
    base = _root(app_id, sf_dir)
    staged = f"{base}/staged/{kind}"
    ARCHIVE[kind](events(spark, sf_dir)).write.partitionBy(KEY, "file").text(staged)
    # Spark names its part files itself; the archive's scanners go by file name, so each is renamed once.
    jvm = spark.sparkContext._jvm
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in fs.globStatus(path(f"{staged}/*/*/part-*")):
        source = found.getPath()
        file_name = source.getParent().getName().split("=", 1)[1]
        deployment = source.getParent().getParent().getName().split("=", 1)[1]
        folder = path(f"{base}/raw/{deployment}")
        fs.mkdirs(folder)
        fs.rename(source, path(f"{base}/raw/{deployment}/{file_name}"))
    if kind == "logs":
        fs.create(path(f"{base}/raw/d0/gems_2023-12-31-00-00.txt")).close()


def archive(spark: SparkSession, sf_dir: str, *kinds: str) -> str:
    """A raw log archive written once per session from `events`, all of it or the kinds of files that are read; returns its root folder."""
    use_utc(spark)
    for kind in kinds or ARCHIVE:
        _archived(spark.sparkContext.applicationId, sf_dir, kind)
    return f"{_root(spark.sparkContext.applicationId, sf_dir)}/raw"


def calibrations(spark: SparkSession) -> DataFrame:
    """The three known light sensors; two have no serial number yet."""
    # Sensor, serial, calibration date, interval, slope, intercept.
    rows = [(1, "50472", None, None, 0.4647, 6.4541, None), (2, None, None, None, 0.2266, -2.6368, None), (3, None, None, None, 0.6644, -2.8579, None)]
    from abyssal.schemas import CALIBRATION_SCHEMA

    return spark.createDataFrame(rows, CALIBRATION_SCHEMA)
