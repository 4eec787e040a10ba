"""Exports of the separately recovered light (PAR) and oxygen loggers, recognised by content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abyssal.functions.common import add_seconds, from_micros, micros, once, write_and_read
from abyssal.functions.scalars import at_least, fahrenheit_to_celsius
from abyssal.functions.text import number, strip, whole_number, without_bom
from abyssal.operators.asof import asof_join
from abyssal.operators.stats import exact_median
from abyssal.ordering import DAY_US, ordered_scan
from abyssal.schemas import CALIBRATION_SCHEMA, KEY
from abyssal.sources.logs import deployment_of, with_file_facts

# Fixed values of the oxygen logger export.
LOCATIONS = ("C1", "C2", "mesocosm")
OTHER_LOCATION = "ambient"
OUT_OF_WATER = -888.88
HEADER_LINES = 10
# The time an undated calibration counts from.
UNDATED = "0001-01-01 00:00:00"


def scan_csv_text(spark: SparkSession, root: str, ids: Sequence[str] | None = None) -> DataFrame:
    """Lines of all CSV exports with their place in the file.

    ``line_id`` is consecutive inside a split, so ``line_id - first`` is the line number in a file's first
    split without ordering the file.
    """
    glob = "*.[cC][sS][vV]"
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
        without_bom(F.make_valid_utf8("value")).alias("line"),
    )
    known = with_file_facts(spark, raw, root, glob, {KEY: deployment_of(F.col("file_path"), root, ids)})
    return known.select(KEY, "file_path", "file_name", "block_start", "line_id", "line")


def par_headers(lines: DataFrame) -> DataFrame:
    """One row per light-logger export: serial number and where its data starts.

    An export starts with `Site Name` and names its logger within the first ten lines.
    """
    line, here = F.col("line"), F.struct("block_start", "line_id")
    first_split = F.col("block_start") == 0
    names_logger = line.startswith("Logger Serial Number")
    info = lines.groupBy(KEY, "file_path", "file_name").agg(
        F.min(F.when(first_split, F.col("line_id"))).alias("first_id"),
        F.min_by("line", F.when(first_split, F.col("line_id"))).alias("first_line"),
        F.min(F.when(first_split & names_logger, F.col("line_id"))).alias("logger_id"),
        F.min(F.when(line.contains("RAW VALUE") & ~names_logger, here)).alias("data_start"),
        F.max(F.when(names_logger & line.contains(","), F.struct(here.alias("at"), line.alias("text")))).alias("logger"),
    )
    return info.where(
        F.col("first_line").startswith("Site Name") & (F.col("logger_id") - F.col("first_id") < HEADER_LINES)
    ).select(
        KEY,
        "file_path",
        "file_name",
        "data_start",
        strip(F.regexp_extract("logger.text", r"^[^,]*,(.*)$", 1)).alias("serial_number"),
    )


def read_par_rows(lines: DataFrame, time_offset_h: float | DataFrame = 0.0) -> DataFrame:
    """Data rows of the light loggers: time (logger clock plus offset), scan number, raw counts, serial.

    The offset is one number or a (deployment_id, par_time_offset_h) table.
    """
    at = lambda i: F.get("__f", F.lit(i))
    stamp = F.try_to_timestamp(F.concat_ws(" ", strip(at(1)), strip(at(2))), F.lit("d/M/yyyy H:m:s")).cast("timestamp_ntz")
    heads = par_headers(lines)
    if isinstance(time_offset_h, DataFrame):
        heads = heads.join(time_offset_h.select(KEY, "par_time_offset_h"), KEY)
    else:
        heads = heads.withColumn("par_time_offset_h", F.lit(float(time_offset_h)))
    heads = write_and_read(heads)  # a row per file, of known size: the lines need no shuffle to meet it
    offset_s = F.col("par_time_offset_h") * 3600
    data = lines.join(heads, [KEY, "file_path", "file_name"]).where(
        F.struct("block_start", "line_id") > F.col("data_start")
    )
    values = F.struct(add_seconds(stamp, offset_s).alias("ts"), whole_number(at(0)).alias("scan_no"), number(at(3)).alias("par_raw"))
    rows = once(once(data, "__f", F.split("line", ",")), "__v", values)
    return rows.where("__v.ts IS NOT NULL AND __v.scan_no IS NOT NULL AND __v.par_raw IS NOT NULL").select(
        KEY, "file_path", "file_name", "block_start", "line_id", "serial_number", "__v.*")


def logging_interval(rows: DataFrame) -> DataFrame:
    """Median spacing of consecutive readings per export, in file order; no row below two readings."""
    keys = [KEY, "file_path"]
    stepped = ordered_scan(rows, keys, ["block_start"], ["line_id"], prev={"__prev": F.col("ts")})
    # written: the median reads the steps several times
    steps = write_and_read(stepped.select(*keys, (micros("ts") - micros("__prev")).alias("step_us")))
    return exact_median(steps, keys, F.col("step_us"), "interval_us").select(
        *keys, (F.col("interval_us") / 1e6).alias("interval_s")
    )


def load_calibrations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CALIBRATION_SCHEMA).csv(path, header=True)


def select_calibration(files: DataFrame, calibrations: DataFrame) -> DataFrame:
    """Latest calibration of each file's logger dated on or before its first reading; undated is oldest.

    One calibration counts per logger and date, the one with the highest sensor number. Files then take theirs by an as-of join, so
    files and calibrations of one logger never meet as pairs.
    """
    cal = calibrations.where("serial_number IS NOT NULL").groupBy("serial_number", "cal_date").agg(
        F.max(F.struct("sensor_number", F.col("interval_s").alias("cal_interval_s"), "slope", "intercept")).alias("best"))
    cal = cal.select(
        "serial_number", F.coalesce(F.col("cal_date").cast("timestamp_ntz"), F.lit(UNDATED).cast("timestamp_ntz")).alias("from_ts"),
        F.col("cal_date").isNotNull().cast("bigint").alias("dated"),
        F.struct("best.sensor_number", "cal_date", "best.cal_interval_s", "best.slope", "best.intercept").alias("cal"),
    )
    at = F.coalesce("first_ts", F.lit(UNDATED).cast("timestamp_ntz"))
    found = asof_join(files.select(KEY, "file_path", "serial_number", at.alias("first_ts")), cal, ["serial_number"], ["cal"], "first_ts", "from_ts",
                      right_order="dated", width_us=DAY_US).where("cal IS NOT NULL")
    rank = F.struct("cal.cal_date", "cal.sensor_number")
    return found.groupBy(KEY, "file_path").agg(F.max_by("cal", rank).alias("cal")).select(KEY, "file_path", "cal.*")


def calibrate(rows: DataFrame, calibrations: DataFrame) -> DataFrame:
    """The `par` table: PAR clamped at zero, null without a calibration or when its interval differs.

    Counts are never rescaled between logging intervals. A calibration without an interval is not checked.
    """
    # Parsed once: the interval's medians and the files' first readings would otherwise read the exports again for each of their steps.
    rows = write_and_read(rows)
    files = write_and_read(rows.groupBy(KEY, "file_path", "serial_number").agg(F.min("ts").alias("first_ts")))
    per_file = write_and_read(select_calibration(files, calibrations))  # like the intervals a row per file: readings need no shuffle to meet them
    joined = rows.join(logging_interval(rows), [KEY, "file_path"], "left").join(per_file, [KEY, "file_path"], "left")
    usable = F.col("cal_interval_s").isNull() | (F.col("cal_interval_s") == F.col("interval_s"))
    par = at_least(F.col("par_raw") * F.col("slope") + F.col("intercept"), 0.0)
    return joined.select(
        KEY, "ts", "scan_no", "par_raw", F.when(usable, par).alias("par_umol_m2_s"), "serial_number",
        "sensor_number", "cal_date", "interval_s",
    )


def read_par(
    spark: SparkSession, root: str, calibrations: DataFrame, time_offset_h: float | DataFrame = 0.0,
    start: Column | None = None, end: Column | None = None, ids: Sequence[str] | None = None,
) -> DataFrame:
    """Read, calibrate and trim to ``[start, end)`` (after the clock offset) every light-logger export."""
    par = calibrate(read_par_rows(scan_csv_text(spark, root, ids), time_offset_h), calibrations)
    if start is not None:
        par = par.where(F.col("ts") >= start)
    return par if end is None else par.where(F.col("ts") < end)


def utc_offset_minutes(header: Column) -> Column:
    """Minutes to add to local time, from the `GMT-hh:mm` in the header; the sign covers the minutes too."""
    pattern = r"GMT([+-])(\d{2}):(\d{2})"
    part = lambda i: F.regexp_extract(header, pattern, i)
    total = part(2).try_cast("int") * 60 + part(3).try_cast("int")
    return F.when(part(1) == "-", total).when(part(1) == "+", -total).otherwise(F.lit(0))


def column_index(header: Column, substring: str) -> Column:
    """0-based position of the first quoted-aware header field holding the substring; null if none."""
    fields = F.regexp_extract_all(header, F.lit(r'(?:^|,)("[^"]*"|[^,]*)'), F.lit(1))
    spot = F.array_position(F.transform(fields, lambda f: f.contains(substring)), True)
    return F.when(spot > 0, (spot - 1).cast("int"))


def hobo_headers(lines: DataFrame) -> DataFrame:
    """One row per oxygen-logger export (line 1 holds `Plot Title:`): location and header line."""
    title = lines.where("block_start = 0").groupBy(KEY, "file_path", "file_name").agg(
        F.min("line_id").alias("first_id"), F.min_by("line", "line_id").alias("title"))
    pattern = r'"?Plot Title:\s*([^"]+)"?'
    title = write_and_read(title.where(F.col("title").rlike(pattern)))  # a row per file, which the lines meet without a shuffle
    second = lines.where("block_start = 0").select(
        KEY, "file_path", (F.col("line_id") - 1).alias("first_id"), F.col("line").alias("header")
    )
    named = strip(F.regexp_extract("title", pattern, 1))
    return title.join(second, [KEY, "file_path", "first_id"]).select(
        KEY, "file_path", "file_name", "first_id", "header",
        F.when(named.isin(*LOCATIONS), named).otherwise(F.lit(OTHER_LOCATION)).alias("location"),
    )


def parse_hobo(lines: DataFrame) -> DataFrame:
    """The `hobo_oxygen` table: UTC time, location, oxygen, temperature in Celsius, logger serial."""
    heads = hobo_headers(lines).select(
        KEY, "file_path", "first_id", "location",
        column_index(F.col("header"), "DO conc").alias("do_at"),
        column_index(F.col("header"), "Temp,").alias("temp_at"),
        utc_offset_minutes(F.col("header")).alias("offset_min"),
        F.nullif(F.regexp_extract("header", r"LGR S/N:\s*(\d+)", 1), F.lit("")).alias("serial_number"),
    ).where("do_at IS NOT NULL AND temp_at IS NOT NULL")
    heads = write_and_read(heads)
    at = lambda i: F.get("__f", i)
    stamp = F.try_to_timestamp(F.upper(strip(at(F.lit(1)))), F.lit("M/d/yy h:m:s a")).cast("timestamp_ntz")
    body = lines.join(heads, [KEY, "file_path"]).where("block_start > 0 OR line_id > first_id + 1")
    utc = from_micros(micros(stamp) + F.col("offset_min").cast("bigint") * F.lit(60_000_000))
    values = F.struct(utc.alias("ts"), number(at(F.col("do_at"))).alias("oxygen_mgl"), number(at(F.col("temp_at"))).alias("temp_f"))
    rows = once(once(body, "__f", F.split("line", ",")), "__v", values)
    return rows.where(f"__v.ts IS NOT NULL AND __v.oxygen_mgl IS NOT NULL AND __v.temp_f IS NOT NULL AND __v.oxygen_mgl != {OUT_OF_WATER}").select(
        KEY, "__v.ts", "location", "__v.oxygen_mgl", fahrenheit_to_celsius(F.col("__v.temp_f")).alias("temp_degc"), "serial_number")


def read_hobo(spark: SparkSession, root: str, ids: Sequence[str] | None = None) -> DataFrame:
    return parse_hobo(scan_csv_text(spark, root, ids))
