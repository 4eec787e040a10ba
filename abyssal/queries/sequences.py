"""Filters and ranges, window detection, and as-of joins on the derived streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from abyssal import standin
from abyssal.functions.common import write_and_read
from abyssal.functions.text import iso_with_offset
from abyssal.operators import cycles, ranges, ratios
from abyssal.operators.aggregate import experiment_context
from abyssal.operators.asof import match_to_windows
from abyssal.operators.fluxes import attach_experiment_par, compute_fluxes
from abyssal.plans.views import hydrogen_with_points
from abyssal.queries.base import query
from abyssal.queries.ctes import CTES, match
from abyssal.queries.logs import CALIBRATION_ROWS, user_calibrations
from abyssal.schemas import KEY
from abyssal.sources import loggers

D = KEY
CTES["calib"] = CALIBRATION_ROWS
STREAMS = ("rga", "valve", "scalup", "status", "system_health", "par", "hobo")


def _cycles(spark, d, settle):
    """Cycle windows as a written table: computed once, size known to the optimiser."""
    return write_and_read(cycles.cycle_windows(standin.valve(spark, d), settle))


def _bounds(spark, d):
    return ranges.time_bounds(standin.streams(spark, d))


ALL_TIMES = " UNION ALL ".join(f"SELECT deployment_id, '{'hobo_oxygen' if t == 'hobo' else t}' AS tbl, ts FROM {t}" for t in STREAMS)
CTES["bounds"] = f"SELECT deployment_id, min(ts) AS lo, max(ts) AS hi FROM ({ALL_TIMES}) GROUP BY ALL"


@query("FLT01", f"{D} ts mass current", f"""
SELECT r.{D}, ts, mass, current FROM rga r JOIN dep USING ({D}) WHERE ts >= start AND ("end" IS NULL OR ts < "end")""")
def clipped(spark, d):
    return ranges.clip(standin.rga(spark, d), standin.deployments(spark, d))


@query("FLT02", f"{D} table rows", f"""
SELECT {D}, tbl AS "table", count(*) AS rows FROM (
  SELECT {D}, tbl, ts FROM ({ALL_TIMES}) WHERE tbl IN ('rga', 'valve', 'par') UNION ALL SELECT {D}, 'chamber_cycles', window_start FROM cycles60
  UNION ALL SELECT {D}, 'fluxes', experiment_start FROM light_response) JOIN dep USING ({D})
WHERE ts >= start AND ("end" IS NULL OR ts < "end") GROUP BY ALL UNION ALL SELECT {D}, 'pi_fit', count(*) FROM ev GROUP BY ALL""")
def clipped_tables(spark, d):
    """Every table by its own time column; the timeless one passes."""
    t = standin.streams(spark, d, "rga", "valve", "par")
    t["chamber_cycles"] = cycles.cycle_windows(t["valve"], 60.0).withColumnRenamed("window_start", "timestamp")
    t["fluxes"] = standin.light_response(spark, d)
    t["pi_fit"] = standin.events(spark, d).select(D, "event_id")
    clipped = ranges.clip_tables(t, standin.deployments(spark, d))
    return ranges.overview(clipped).select(D, "table", "rows")


@query("FLT03", f"{D} table rows first_ts last_ts", f"""
SELECT {D}, tbl AS "table", count(*) AS rows, min(ts) AS first_ts, max(ts) AS last_ts FROM ({ALL_TIMES}) x JOIN bounds USING ({D})
WHERE ts BETWEEN greatest(lo, hi - INTERVAL 7 DAY) AND hi GROUP BY ALL""")
def ranged_tables(spark, d):
    b = ranges.preset_ranges(_bounds(spark, d)).where("preset = 'Last 7 days'").select(D, F.col("range_start").alias("lo"), F.col("range_end").alias("hi"))
    return ranges.overview(ranges.filter_to_range(standin.streams(spark, d), b))


@query("FLT04", "table time_column n", """
SELECT tbl AS "table", CASE tbl WHEN 'chamber_cycles' THEN 'timestamp' ELSE 'ts' END AS time_column, count(*) AS n FROM (
  SELECT 'rga' AS tbl FROM rga UNION ALL SELECT 'scalup' FROM scalup UNION ALL SELECT 'chamber_cycles' FROM cycles60) GROUP BY ALL""")
def time_columns(spark, d):
    t = standin.streams(spark, d, "rga", "scalup")
    t["chamber_cycles"] = cycles.cycle_windows(standin.valve(spark, d), 60.0).withColumnRenamed("window_start", "timestamp")
    rows = ranges.overview(t).groupBy("table").agg(F.sum("rows").alias("n"))
    name = F.lit(None).cast("string")
    for n in t:
        name = F.when(F.col("table") == n, ranges.time_column(n)).otherwise(name)
    return rows.withColumn("time_column", name)


@query("FLT05", f"{D} lo hi", "SELECT * FROM bounds")
def bounds(spark, d):
    return _bounds(spark, d)


@query("FLT06", f"{D} preset range_start range_end", f"""
SELECT {D}, preset, CASE WHEN s IS NULL THEN lo ELSE greatest(lo, hi - to_seconds(s)) END AS range_start, hi AS range_end
FROM bounds, (VALUES ('All data', NULL), ('Last hour', 3600), ('Last 6 hours', 21600), ('Last 24 hours', 86400), ('Last 7 days', 604800)) p(preset, s)""")
def presets(spark, d):
    return ranges.preset_ranges(_bounds(spark, d))


@query("FLT07", f"{D} range_start range_end", f"""
SELECT {D}, greatest(lo, TIMESTAMP '2024-01-01') AS range_start, least(hi, TIMESTAMP '2024-01-14 23:59:59.999999') AS range_end FROM bounds""")
def whole_days(spark, d):
    return ranges.date_range(_bounds(spark, d), F.lit("2024-01-01").cast("date"), F.lit("2024-01-14").cast("date"))


@query("FLT08", f"{D} experiment_number window_start", f"""
SELECT c.{D}, c.experiment_number, c.window_start FROM cycles60 c JOIN spans60 s USING ({D}, experiment_number) JOIN bounds USING ({D})
WHERE experiment_start BETWEEN greatest(lo, hi - INTERVAL 7 DAY) AND hi""")
def whole_experiments(spark, d):
    w = _cycles(spark, d, 60.0)
    b = ranges.preset_ranges(_bounds(spark, d)).where("preset = 'Last 7 days'").select(D, F.col("range_start").alias("lo"), F.col("range_end").alias("hi"))
    return ranges.keep_experiments(w, ranges.experiments_in_range(cycles.experiment_spans(w, 60.0), b))


CALIBRATED = f"""
SELECT {D}, date_trunc('second', ts) AS ts, event_id AS scan_no, raw AS par_raw,
       CASE WHEN n <> 7 THEN greatest(0.0::DOUBLE, raw * 0.4647::DOUBLE + 6.4541::DOUBLE) END AS par_umol_m2_s, CASE WHEN n = 7 THEN '11111' ELSE '50472' END AS serial_number,
       CASE WHEN n <> 7 THEN 1::BIGINT END AS sensor_number, median(gap) OVER (PARTITION BY {D}) AS interval_s
FROM (SELECT *, CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN floor(value * 20) ELSE (k % 7)::DOUBLE END AS raw,
             (epoch_us(date_trunc('second', ts)) - lag(epoch_us(date_trunc('second', ts))) OVER (PARTITION BY {D} ORDER BY event_id)) / 1e6 AS gap
      FROM ev WHERE k <> 77)"""


@query("FLT09", f"{D} ts scan_no par_umol_m2_s:4", f"SELECT * FROM ({CALIBRATED}) WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'")
def trimmed_light(spark, d):
    lit = lambda s: F.lit(s).cast("timestamp_ntz")
    return loggers.read_par(spark, standin.archive(spark, d, "exports"), standin.calibrations(spark), 0.0, lit("2024-01-05"), lit("2024-01-20"))


@query("FLT10", f"{D} window_start chamber condition", f"SELECT {D}, window_start, chamber, CASE chamber WHEN 'C1' THEN c1 ELSE c2 END AS condition FROM cycles60 JOIN dep USING ({D})")
def conditions(spark, d):
    return ranges.with_condition(cycles.cycle_windows(standin.valve(spark, d), 60.0), standin.deployments(spark, d))


@query("FLT11", f"{D} site test label", f"SELECT {D}, site, test, {D} || ' — ' || site AS label FROM dep WHERE NOT test")
def processed(spark, d):
    return ranges.list_deployments(standin.deployments(spark, d), standin.streams(spark, d, "rga", "valve"))


@query("FLT12", f"{D} table rows first_ts last_ts", f'SELECT {D}, tbl AS "table", count(*) AS rows, min(ts) AS first_ts, max(ts) AS last_ts FROM ({ALL_TIMES}) GROUP BY ALL')
def overviews(spark, d):
    return ranges.overview(standin.streams(spark, d))


# --- sequence and session operators ------------------------------------------------------------------------


@query("SEQ01", f"{D} ts chamber flush_state", f"SELECT {D}, ts, chamber, flush_state FROM transitions")
def deduped(spark, d):
    return cycles.dedupe_consecutive(standin.valve(spark, d))


@query("SEQ02", f"{D} ts chamber flush_state experiment_number exp_start", f"SELECT {D}, ts, chamber, flush_state, experiment_number, exp_start FROM labelled")
def numbered(spark, d):
    return cycles.label_experiments(standin.valve(spark, d))


CYCLE_SPEC = f"{D} window_start window_end chamber experiment_number elapsed_us"


@query("SEQ03", CYCLE_SPEC, "SELECT * FROM cycles60")
def windows60(spark, d):
    return cycles.cycle_windows(standin.valve(spark, d), 60.0)


@query("SEQ04", f"{D} experiment_number experiment_start experiment_end", "SELECT * FROM spans60")
def spans(spark, d):
    return cycles.experiment_spans(_cycles(spark, d, 60.0), 60.0)


@query("SEQ05", f"{D} segment window_start window_end", f"SELECT {D}, segment, window_start, window_end FROM scan_windows")
def scan_spans(spark, d):
    return cycles.scan_windows(standin.rga(spark, d))


@query("SEQ06", f"{D} start end chamber", f'SELECT {D}, window_start AS start, window_end AS "end", chamber FROM cycles0')
def chamber_spans(spark, d):
    return cycles.active_chamber_spans(standin.valve(spark, d))


@query("SEQ07", f"{D} experiment_number experiment_start", f"""
SELECT {D}, experiment_number, make_timestamp(min(epoch_us(window_start) - elapsed_us)) AS experiment_start FROM cycles0 GROUP BY ALL""")
def starts(spark, d):
    return cycles.experiment_starts(cycles.cycle_windows(standin.valve(spark, d), 0.0), "window_start")


@query("SEQ08", f"{D} experiment_number experiment_start", f"""
SELECT {D}, experiment_number, experiment_start FROM spans60 JOIN bounds USING ({D}) WHERE experiment_start BETWEEN greatest(lo, hi - INTERVAL 24 HOUR) AND hi""")
def starts_in_range(spark, d):
    w = _cycles(spark, d, 60.0)
    b = ranges.preset_ranges(_bounds(spark, d)).where("preset = 'Last 24 hours'").select(D, F.col("range_start").alias("lo"), F.col("range_end").alias("hi"))
    return ranges.experiments_in_range(cycles.experiment_starts(w, "window_start", settle_s=60.0), b)


# --- joins --------------------------------------------------------------------------------------------------


@query("JN01", f"{D} ts mass current window_start window_end", f"SELECT {D}, ts, mass, current, window_start, window_end FROM ({match('rga', 'cycles60')})")
def readings_in_windows(spark, d):
    w = _cycles(spark, d, 60.0)
    return match_to_windows(standin.rga(spark, d), w.select(D, "window_start", "window_end"))


@query("JN02", f"{D} window_start window_end chamber experiment_number elapsed_us", "SELECT * FROM scan_context")
def scans_in_cycles(spark, d):
    return cycles.attach_chamber_context(cycles.scan_windows(standin.rga(spark, d)), _cycles(spark, d, 60.0))


CTES["context0"] = f"""
SELECT {D}, ts, chamber, experiment_number, elapsed, trunc((epoch_us(ts) - epoch_us(window_start)) / 1e6) < 60 AS settled_out, oxygen_mgl, temp_degc, sal_psu, pressure_mbar, ph FROM (
  SELECT r.*, w.window_start, w.window_end, w.chamber, w.experiment_number, epoch_us(r.ts) - epoch_us(w.window_start) + w.elapsed_us AS elapsed
  FROM scalup r ASOF JOIN cycles0 w ON r.{D} = w.{D} AND r.ts >= w.window_start) WHERE ts < window_end"""


@query("JN03", f"{D} ts chamber experiment_number elapsed_us settled_out", "SELECT *, elapsed AS elapsed_us FROM context0")
def contexts(spark, d):
    return experiment_context(standin.scalup(spark, d), _cycles(spark, d, 0.0), 60.0)


def nearest(left: str, right: str, value: str, keys: str = D) -> str:
    """Nearest right row by time, the earlier on a tie, from a backward and a forward as-of join."""
    on = " AND ".join(f"l.{k} = r.{k}" for k in keys.split(", "))
    back = f"SELECT l.*, r.ts AS bts, r.{value} AS bv FROM {left} l ASOF LEFT JOIN {right} r ON {on} AND l.ts >= r.ts"
    both = f"SELECT l.*, r.ts AS fts, r.{value} AS fv FROM ({back}) l ASOF LEFT JOIN {right} r ON {on} AND l.ts <= r.ts"
    return f"""SELECT *, CASE WHEN fts IS NULL OR (bts IS NOT NULL AND epoch_us(ts) - epoch_us(bts) <= epoch_us(fts) - epoch_us(ts)) THEN bv ELSE fv END AS near FROM ({both})"""


CTES["ratio_full"] = f"""SELECT *, current / near AS ratio FROM ({nearest('(SELECT * FROM rga WHERE mass <> 40)', '(SELECT * FROM rga WHERE mass = 40)', 'current')})
WHERE near <> 0"""


@query("JN04", f"{D} ts mass ratio:6", "SELECT * FROM ratio_full")
def mass_ratios(spark, d):
    return ratios.ratio_to_mass(standin.rga(spark, d))


CTES["hobo_diff"] = f"""SELECT *, near - oxygen_mgl AS diff_mgl FROM (
{nearest("(SELECT * FROM hobo WHERE location IN ('C1', 'C2'))", "(SELECT * FROM hobo WHERE location = 'mesocosm')", 'oxygen_mgl')}) WHERE near IS NOT NULL"""


@query("JN05", f"{D} ts location diff_mgl:6", "SELECT * FROM hobo_diff")
def oxygen_differences(spark, d):
    return ratios.mesocosm_difference(standin.hobo(spark, d))


@query("JN08", f"{D} ts par_umol_m2_s:4 experiment_number", f"""
SELECT * FROM (SELECT r.*, s.experiment_number, s.experiment_end FROM (SELECT * FROM par WHERE par_umol_m2_s IS NOT NULL) r
ASOF JOIN spans60 s ON r.{D} = s.{D} AND r.ts >= s.experiment_start) WHERE ts < experiment_end""")
def light_in_experiments(spark, d):
    w = cycles.experiment_spans(_cycles(spark, d, 60.0), 60.0)
    right = w.select(D, F.col("experiment_start").alias("window_start"), F.col("experiment_end").alias("window_end"), "experiment_number")
    return match_to_windows(standin.par(spark, d).where("par_umol_m2_s IS NOT NULL"), right)


def _layer_c(spark, d):
    from abyssal.queries.averages import staged_layer_c

    return staged_layer_c(spark, d)


@query("JN10", f"{D} experiment_number chamber variable output_value:5 par_mean_umol_m2_s:4 par_coverage:5", "SELECT * FROM fluxes_par")
def fluxes_with_light(spark, d):
    s = cycles.experiment_spans(_cycles(spark, d, 60.0), 60.0)
    return attach_experiment_par(compute_fluxes(_layer_c(spark, d)), standin.par(spark, d), s)


@query("JN11", f"{D} experiment_number chamber h_ion_flux:6@1000000 o2_flux_mmol_m2_h:5 period used", f"""
SELECT m.*, f.output_value AS h_ion_flux FROM metab m JOIN (SELECT * FROM fluxes WHERE variable = 'h_ion') f USING ({D}, experiment_number, chamber)
WHERE par_chamber_umol_m2_s IS NOT NULL""")
def hydrogen_and_oxygen(spark, d):
    from abyssal.queries.domain import recomputed

    out = recomputed(spark, d)
    return hydrogen_with_points(out["metabolism"], out["fluxes"])


@query("JN15", f"{D} file_path sensor_number cal_date slope:4", f"""
SELECT * EXCLUDE (cal_date), cal_date::VARCHAR AS cal_date FROM (
  SELECT f.{D}, f.file_path, c.sensor_number, c.cal_date, c.slope, row_number() OVER (PARTITION BY f.{D}, f.file_path ORDER BY c.cal_date DESC NULLS LAST, c.sensor_number DESC) AS r
  FROM (SELECT {D}, 'u' || user_id AS file_path, 'S' || (user_id % 40) AS serial_number, min(ts) + INTERVAL 5 DAY AS first_ts FROM ev GROUP BY ALL) f
  JOIN (SELECT serial_number, sensor_number, cal_date, max(slope) AS slope FROM calib GROUP BY ALL) c
    ON f.serial_number = c.serial_number AND (c.cal_date IS NULL OR c.cal_date <= CAST(f.first_ts AS DATE))) WHERE r = 1""")
def effective_calibrations(spark, d):
    e = standin.events(spark, d)
    files = e.groupBy(D, "user_id").agg((F.min("ts") + F.expr("INTERVAL '5' DAY")).alias("first_ts")).select(
        D, F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("file_path"), F.concat(F.lit("S"), (F.col("user_id") % 40).cast("string")).alias("serial_number"), "first_ts")
    cals = user_calibrations(spark, d).groupBy("serial_number", "sensor_number", "cal_date").agg(
        F.max("slope").alias("slope"), F.first("interval_s").alias("interval_s"), F.first("intercept").alias("intercept"))
    return loggers.select_calibration(files, cals).withColumn("cal_date", F.col("cal_date").cast("string"))


@query("JN16", f"{D} ts mass ratio:6 chamber experiment_number settled_out", f"""
SELECT r.*, w.chamber, w.experiment_number, trunc((epoch_us(r.ts) - epoch_us(w.window_start)) / 1e6) < 60 AS settled_out
FROM ratio_full r ASOF JOIN cycles0 w ON r.{D} = w.{D} AND r.ts >= w.window_start WHERE r.ts < w.window_end""")
def ratios_with_context(spark, d):
    """The ratio over the whole stream, with each reading's experiment context carried along."""
    rows = ratios.ratio_to_mass(standin.rga(spark, d))
    return experiment_context(rows, _cycles(spark, d, 0.0), 60.0)


@query("SCF17", "event_id parsed", "SELECT event_id, CASE k % 5 WHEN 4 THEN NULL ELSE date_trunc('second', ts) END AS parsed FROM ev")
def offsets(spark, d):
    e = standin.events(spark, d)
    k = F.col("k") % 5
    text = lambda shift: F.date_format(F.col("ts") + F.expr(f"INTERVAL '{shift}' MINUTE"), "yyyy-MM-dd'T'HH:mm:ss")
    s = (
        F.when(k == 0, text(0)).when(k == 1, F.concat(text(0), F.lit("Z"))).when(k == 2, F.concat(text(-240), F.lit("-04:00")))
        .when(k == 3, F.concat(text(330), F.lit("+05:30"))).otherwise(F.lit("  "))
    )
    return e.select("event_id", iso_with_offset(s).alias("parsed"))
