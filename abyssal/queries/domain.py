"""Fluxes, metabolism, curve fits, registry, views and the whole batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from abyssal import standin
from abyssal.functions import seawater
from abyssal.functions.common import shared_dir, write_and_read
from abyssal.operators import cycles, fluxes, metabolism, registry
from abyssal.plans import recompute, views
from abyssal.plans.batch import run_batch
from abyssal.queries.averages import layer_c, readings, staged_layer_c
from abyssal.queries.base import query
from abyssal.queries.ctes import CTES, MASSES, cycle_candidates, density_sql, layer, metabolism as metabolism_sql, solubility_sql
from abyssal.queries.ctes import fluxes as fluxes_sql
from abyssal.queries.logs import resolved
from abyssal.queries.sequences import CALIBRATED, nearest
from abyssal.schemas import KEY
from abyssal.sources import loggers

D = KEY
FLUX_SPEC = f"{D} experiment_number chamber experiment_start variable slope_native_per_min:5@1000 r2:5 n_points output_value:4@1000 output_unit"


def _fluxes(spark, d):
    return fluxes.compute_fluxes(staged_layer_c(spark, d))


@query("DOM01", FLUX_SPEC, "SELECT * FROM fluxes")
def all_fluxes(spark, d):
    return _fluxes(spark, d)


@query("DOM02", FLUX_SPEC, "SELECT * FROM fluxes WHERE variable <> 'temp_degC'")
def areal_fluxes(spark, d):
    return _fluxes(spark, d).where("variable != 'temp_degC'")


@query("DOM03", FLUX_SPEC, "SELECT * FROM fluxes WHERE variable = 'temp_degC'")
def temperature_rates(spark, d):
    return _fluxes(spark, d).where("variable = 'temp_degC'")


@query("DOM04", f"{D} experiment_number chamber timestamp n2_umol_l:4", f"""
SELECT c.*, mass_28_avg / mass_40_avg / 1.2 * {solubility_sql('Ar', 't0', 's0')} * {density_sql('t0', 's0')} AS n2_umol_l
FROM (SELECT * FROM layer_c WHERE mass_40_avg <> 0) c LEFT JOIN (
  SELECT {D}, experiment_number, chamber, arg_min(temp_degC, "timestamp") AS t0, arg_min(sal_PSU, "timestamp") AS s0 FROM layer_c
  WHERE mass_40_avg <> 0 AND temp_degC IS NOT NULL AND sal_PSU IS NOT NULL GROUP BY ALL) a USING ({D}, experiment_number, chamber)""")
def nitrogen(spark, d):
    return fluxes.dissolved_n2(staged_layer_c(spark, d), 1.2)


@query("DOM05", f"{D} ts ar:6 n2:6", f"SELECT {D}, ts, {solubility_sql('Ar', 'temp_degc', 'sal_psu')} AS ar, {solubility_sql('N2', 'temp_degc', 'sal_psu')} AS n2 FROM scalup")
def solubilities(spark, d):
    t, s = F.col("temp_degc"), F.col("sal_psu")
    return standin.scalup(spark, d).withColumns({"ar": seawater.gas_solubility("Ar", t, s), "n2": seawater.gas_solubility("N2", t, s)})


@query("DOM06", f"{D} ts density:9", f"SELECT {D}, ts, {density_sql('temp_degc', 'sal_psu')} AS density FROM scalup")
def densities(spark, d):
    return standin.scalup(spark, d).withColumn("density", seawater.seawater_density(F.col("temp_degc"), F.col("sal_psu")))


@query("DOM07", f"{D} ts factor:7", f"""
SELECT {D}, ts, pressure_mbar / 30 / ({solubility_sql('N2', 'temp_degc', 'sal_psu')} / {solubility_sql('Ar', 'temp_degc', 'sal_psu')}) AS factor FROM scalup""")
def sensitivity_factors(spark, d):
    return standin.scalup(spark, d).withColumn("factor", seawater.n2_ar_sensitivity(F.col("pressure_mbar") / 30, F.col("temp_degc"), F.col("sal_psu")))


@query("DOM08", "event_id chamber_volume_l:6 chamber_height_m:6 problem", """
SELECT event_id, CASE WHEN problem IS NULL THEN coalesce(v, h * a * 1000) END AS chamber_volume_l, CASE WHEN problem IS NULL THEN coalesce(h, v / a / 1000) END AS chamber_height_m, problem
FROM (SELECT *, CASE WHEN (v IS NULL) = (h IS NULL) THEN 'give exactly one of chamber_volume_l or chamber_height_m' WHEN NOT a > 0 THEN 'chamber_area_m2 must be positive'
                     WHEN h IS NOT NULL AND NOT h > 0 THEN 'chamber_height_m must be positive' WHEN v IS NOT NULL AND NOT v > 0 THEN 'chamber_volume_l must be positive' END AS problem
      FROM (SELECT event_id, CASE WHEN k % 3 <> 1 THEN k - 5.0::DOUBLE END AS v, CASE WHEN k % 3 = 1 OR k % 7 = 0 THEN (k - 10) / 100.0::DOUBLE END AS h, (k % 11) / 10.0::DOUBLE AS a FROM ev))""")
def geometries(spark, d):
    k = F.col("k")
    return fluxes.chamber_geometry(standin.events(spark, d).select(
        "event_id", F.when(k % 3 != 1, k - 5.0).alias("chamber_volume_l"), F.when((k % 3 == 1) | (k % 7 == 0), (k - 10) / 100).alias("chamber_height_m"), (k % 11 / 10).alias("chamber_area_m2")))


METAB_SPEC = (f"{D} experiment_number chamber experiment_start par_chamber_umol_m2_s:4 par_coverage:6 o2_flux_mmol_m2_h:4 r2:5 period used excluded_reason "
              "ncp_mmol_m2_h:4 gpp_mmol_m2_h:4")
CTES["metab_t"] = metabolism_sql("light_response", 300, 0.9, 0.05, 0.8)


@query("DOM09", METAB_SPEC, "SELECT * FROM metab_t")
def classified(spark, d):
    return metabolism.classify_o2_fluxes(standin.light_response(spark, d), 300.0, 0.9, 0.05, 0.8)


def pi_ctes(prefix: str, source: str) -> str:
    """The same least-squares definition searched over ln k in plain SQL; returns the final select."""
    CTES[f"{prefix}_used"] = f"SELECT {D}, chamber, period, par_chamber_umol_m2_s AS i, o2 AS y FROM {source} WHERE used"
    CTES[f"{prefix}_counts"] = (f"SELECT {D}, chamber, count(*) AS n_points, count_if(period = 'light')::BIGINT AS n_light, count_if(period = 'dark')::BIGINT AS n_dark, "
                                f"-avg(CASE WHEN period = 'dark' THEN y END) AS r_dark_mmol_m2_h, avg(y) AS ym FROM {prefix}_used GROUP BY ALL")
    CTES[f"{prefix}_limits"] = (f"SELECT {D}, chamber, ln(1e-3 / max(i)) AS lo, ln(6.0 / min(CASE WHEN i > 0 THEN i END)) AS hi, avg(y) AS my FROM {prefix}_used "
                                f"GROUP BY ALL HAVING count(*) >= 4 AND count_if(period = 'light') > 0 AND max(i) > 0")
    # The squared error on 17 values, zoomed 16-fold six times by its least value, and at last its derivative by interpolation.
    centre, half = f"(SELECT *, (lo + hi) / 2 AS lnk, (hi - lo) / 2 AS half FROM {prefix}_limits)", 8
    for level in range(7):
        CTES[f"{prefix}_g{level}"] = f"""
SELECT {D}, chamber, j, any_value(lnk) AS lnk, any_value(lo) AS lo, any_value(hi) AS hi, any_value(half) AS half, regr_slope(y, x) AS pmax, regr_intercept(y, x) AS b, regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x) AS sse,
       -2 * regr_slope(y, x) * (regr_sxy(y, p) - regr_slope(y, x) * regr_sxy(x, p)) AS slope
  FROM (SELECT *, tanh(exp(lnk) * i) AS x, exp(lnk) * i * (1 - pow(tanh(exp(lnk) * i), 2)) AS p FROM (
    SELECT u.{D}, u.chamber, j, lo, hi, half, greatest(lo, least(hi, lnk + (j - 8) * half / 8)) AS lnk, i, y - my AS y
    FROM {prefix}_used u JOIN {centre} c USING ({D}, chamber), (SELECT unnest(range(17)) AS j))) GROUP BY {D}, chamber, j"""
        CTES[f"{prefix}_b{level}"] = f"SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY {D}, chamber ORDER BY sse, j) AS r FROM {prefix}_g{level} WHERE pmax > 1e-9) WHERE r = 1"
        centre = f"(SELECT b.{D}, b.chamber, b.lnk, b.lo, b.hi, b.half / 8 AS half, my FROM {prefix}_b{level} b JOIN {prefix}_limits USING ({D}, chamber))"
    CTES[f"{prefix}_k"] = f"""
SELECT b.{D}, b.chamber, b.lnk <= b.lo OR b.lnk >= b.hi AS bound,
       CASE WHEN b.lnk <= b.lo OR b.lnk >= b.hi OR n.slope IS NULL OR m.slope IS NULL OR n.slope <= m.slope THEN b.lnk ELSE m.lnk - m.slope * (n.lnk - m.lnk) / (n.slope - m.slope) END AS lnk
FROM {prefix}_b6 b LEFT JOIN {prefix}_g6 m ON b.{D} = m.{D} AND b.chamber = m.chamber AND m.j = b.j - 1 LEFT JOIN {prefix}_g6 n ON b.{D} = n.{D} AND b.chamber = n.chamber AND n.j = b.j + 1"""
    CTES[f"{prefix}_p"] = f"""
SELECT {D}, chamber, any_value(lnk) AS lnk, any_value(bound) AS bound, regr_slope(y, tanh(exp(lnk) * i)) AS pmax, regr_slope(y, tanh(exp(lnk) * i)) * exp(any_value(lnk)) AS alpha, regr_intercept(y, tanh(exp(lnk) * i)) AS b
FROM {prefix}_used JOIN {prefix}_k USING ({D}, chamber) GROUP BY ALL
UNION ALL SELECT {D}, chamber, 0.0, true, 1e-9, 1e-9, my FROM {prefix}_limits ANTI JOIN {prefix}_k USING ({D}, chamber)"""
    return f"""
SELECT c.{D}, c.chamber, n_points, n_light, n_dark, r_dark_mmol_m2_h, pmax AS pmax_mmol_m2_h, alpha AS alpha_mmol_m2_h_per_par, -b AS r_fit_mmol_m2_h,
       pmax / alpha AS ik_umol_m2_s, fit_r2, pmax IS NOT NULL AS converged, CASE WHEN NOT bound THEN sqrt(s2 * (bb * n - sb * sb) / det) END AS pmax_se,
       CASE WHEN NOT bound THEN sqrt(s2 * (aa * n - sa * sa) / det) END AS alpha_se, CASE WHEN NOT bound THEN sqrt(s2 * (aa * bb - ab * ab) / det) END AS r_fit_se
FROM {prefix}_counts c LEFT JOIN {prefix}_p p USING ({D}, chamber) LEFT JOIN (
  SELECT *, sse / (n - 3) AS s2, aa * (bb * n - sb * sb) - ab * (ab * n - sb * sa) + sa * (ab * sb - bb * sa) AS det FROM (
    SELECT {D}, chamber, sum(a * a) AS aa, sum(a * b) AS ab, sum(a) AS sa, sum(b * b) AS bb, sum(b) AS sb, count(*)::DOUBLE AS n, sum(e * e) AS sse, 1 - sum(e * e) / sum(t * t) AS fit_r2
    FROM (SELECT u.{D}, u.chamber, tanh(v) - v * (1 - pow(tanh(v), 2)) AS a, i * (1 - pow(tanh(v), 2)) AS b, y - (pmax * tanh(v) + p0) AS e, y - ym AS t
          FROM (SELECT w.*, ym, pmax, p.b AS p0, alpha / pmax * i AS v FROM {prefix}_used w JOIN {prefix}_counts USING ({D}, chamber) JOIN {prefix}_p p USING ({D}, chamber)) u) GROUP BY ALL)) q USING ({D}, chamber)"""


PI_SPEC = (f"{D} chamber n_points n_light n_dark r_dark_mmol_m2_h:4 pmax_mmol_m2_h:2 alpha_mmol_m2_h_per_par:4 r_fit_mmol_m2_h:2 ik_umol_m2_s:2 fit_r2:6 converged "
           "pmax_se:3 alpha_se:5 r_fit_se:3")


CTES["pi_fit_lr"] = pi_ctes("pia", "metab_lr")


@query("DOM10", PI_SPEC, "SELECT * FROM pi_fit_lr")
def curve_fits(spark, d):
    return metabolism.fit_pi_curves(metabolism.classify_o2_fluxes(standin.light_response(spark, d)))


@query("DOM11", f"{D} chamber point par:2 flux:1", f"""
SELECT f.{D}, f.chamber, g.p AS point, top * p / 199 AS par, pmax_mmol_m2_h * tanh(alpha_mmol_m2_h_per_par * (top * p / 199) / pmax_mmol_m2_h) - r_fit_mmol_m2_h AS flux
FROM pi_fit_lr f JOIN (SELECT {D}, max(par_chamber_umol_m2_s) * 1.05 AS top FROM metab_lr GROUP BY ALL) t USING ({D}), (SELECT unnest(range(200)) AS p) g WHERE converged""")
def fitted_curves(spark, d):
    m = metabolism.classify_o2_fluxes(standin.light_response(spark, d))
    return metabolism.pi_curves(write_and_read(metabolism.fit_pi_curves(m)), m)


@query("DOM12", f"{D} ts scan_no par_raw par_umol_m2_s:4 serial_number sensor_number interval_s:6", f"SELECT * FROM ({CALIBRATED})")
def calibrated(spark, d):
    return loggers.read_par(spark, standin.archive(spark, d, "exports"), standin.calibrations(spark))


SETS = [{"settle_offset_s": 60.0}, {"settle_offset_s": 300.0, "chamber_volume_l": 24.0, "total_pressure_sensitivity_a_per_torr": 2e-5}]


def recomputed(spark, d, fit=False):
    """Layers C to E per deployment with default parameters, from the raw streams."""
    valve = standin.valve(spark, d)
    parameters = recompute.with_parameter_sets(valve.select(D).distinct(), [{}]).drop("param_id")
    windows = write_and_read(cycles.cycle_windows(valve, 60.0))
    return recompute.layers_from_streams(readings(spark, d), valve, parameters, MASSES, fit=fit, windows=windows)


CTES["cycles300"] = f"SELECT * FROM ({cycle_candidates(300)}) WHERE window_end > window_start"
CTES["layer_c300"] = layer("cycles300", tp="2e-5")
CTES["fluxes300"] = fluxes_sql("layer_c300", "24.0")


@query("DOM13", f"{D} param_id experiment_number chamber variable slope_native_per_min:5@1000 n_points output_value:4@1000", """
SELECT 0::BIGINT AS param_id, * FROM fluxes UNION ALL SELECT 1::BIGINT, * FROM fluxes300""")
def parameter_grid(spark, d):
    """Two parameter sets in one job."""
    return recompute.recompute_grid(standin.streams(spark, d, "rga", "scalup", "status", "par", "valve"), SETS, MASSES, fit=False)["fluxes"]


CTES["metab_range"] = "SELECT m.* FROM metab_lr m WHERE experiment_start BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-20'"
CTES["pi_fit_range"] = pi_ctes("pib", "metab_range")


@query("DOM14", PI_SPEC, "SELECT * FROM pi_fit_range")
def refitted(spark, d):
    m = metabolism.classify_o2_fluxes(standin.light_response(spark, d))
    bounds = standin.deployments(spark, d).select(D, F.lit("2024-01-03").cast("timestamp_ntz").alias("lo"), F.lit("2024-01-20").cast("timestamp_ntz").alias("hi"))
    return views.refit_in_range(m, bounds)


BROKEN = f"""SELECT 'u' || user_id AS {D}, CASE WHEN user_id % 9 <> 0 THEN 'x' END AS site, min(ts) AS start, CASE WHEN user_id % 7 = 0 THEN min(ts) - INTERVAL 1 DAY ELSE max(ts) + INTERVAL 1 DAY END AS "end",
  CASE WHEN user_id % 11 = 0 THEN 'rock' ELSE 'grass' END AS c1, user_id FROM ev GROUP BY user_id"""


@query("DOM18", f"{D} rule detail", f"""
SELECT {D}, 'missing required key' AS rule, 'site' AS detail FROM ({BROKEN}) WHERE site IS NULL
UNION ALL SELECT {D}, 'c1 not in vocabulary', c1 FROM ({BROKEN}) WHERE c1 = 'rock'
UNION ALL SELECT {D}, 'end must be after start', strftime("end", '%Y-%m-%d') FROM ({BROKEN}) WHERE "end" <= start
UNION ALL SELECT {D}, 'must be a positive number', 'chamber_area_m2' FROM ({BROKEN}) WHERE user_id % 13 = 0
UNION ALL SELECT {D}, 'unknown processing key', 'colour' FROM ({BROKEN}) WHERE user_id % 17 = 0
UNION ALL SELECT {D}, 'give only one key of a group', 'depth' FROM ({BROKEN}) WHERE user_id % 19 = 0
UNION ALL SELECT o.{D}, 'contains another deployment', 'raw/' || o.{D} || '/' || i.{D} FROM ({BROKEN}) o JOIN ({BROKEN}) i ON i.user_id % 23 = 0 AND o.user_id = i.user_id - 1""")
def violations(spark, d):
    """A registry with one folder per user, some rules broken on purpose."""
    u = F.col("user_id")
    users = standin.events(spark, d).groupBy("user_id").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    day = F.expr("INTERVAL '1' DAY")
    name = lambda n: F.concat(F.lit("u"), n.cast("string"))
    deployments = users.select(
        name(u).alias(D), F.when(u % 9 != 0, "x").alias("site"), F.col("lo").alias("start"), F.when(u % 7 == 0, F.col("lo") - day).otherwise(F.col("hi") + day).alias("end"),
        F.when(u % 11 == 0, "rock").otherwise("grass").alias("c1"), F.lit("none").alias("c2"), F.lit(False).alias("test"),
        F.when(u % 23 == 0, F.concat(F.lit("raw/"), name(u - 1), F.lit("/"), name(u))).otherwise(F.concat(F.lit("raw/"), name(u))).alias("path"))
    cells = F.array(
        F.when(u % 13 == 0, F.struct(F.lit("chamber_area_m2").alias("key"), F.lit(-1.0).alias("value"))),
        F.when(u % 17 == 0, F.struct(F.lit("colour").alias("key"), F.lit(1.0).alias("value"))),
        F.when(u % 19 == 0, F.struct(F.lit("chamber_volume_l").alias("key"), F.lit(1.0).alias("value"))),
        F.when(u % 19 == 0, F.struct(F.lit("chamber_height_m").alias("key"), F.lit(1.0).alias("value"))))
    given = users.select(name(u).alias(D), F.explode(cells).alias("c")).where("c IS NOT NULL").select(D, "c.key", "c.value")
    out = registry.deployment_violations(deployments, given)
    return out.withColumn("detail", F.when(F.col("rule") == "end must be after start", F.substring("detail", 1, 10)).otherwise(F.col("detail")))


@query("DOM19", f"{D} group key value:6@1000000 source", f"""SELECT {D}, grp AS "group", key, value, ['argument', 'deployment', 'config', 'default'][rnk + 1] AS source FROM resolved""")
def parameters(spark, d):
    return resolved(spark, d)


@query("DOM20", f"{D} measure value")
def whole_batch(spark, d):
    """Raw folders to all written tables of every deployment; the run summary."""
    out = shared_dir(spark)
    return run_batch(spark, standin.archive(spark, d), out, standin.deployments(spark, d), standin.given_parameters(spark, d), standin.calibrations(spark))


MEASURED = f"""
SELECT {D}, 'mass_' || mass AS series, ts, current * 1e-16 / 8.01e-5 AS value FROM rga UNION ALL SELECT {D}, 'ratio_' || mass, ts, ratio FROM ratio_full
UNION ALL SELECT {D}, 'sonde_temp_degC', ts, temp_degc FROM scalup UNION ALL SELECT {D}, 'sonde_sal_PSU', ts, sal_psu FROM scalup
UNION ALL SELECT {D}, 'sonde_pressure_mbar', ts, pressure_mbar FROM scalup UNION ALL SELECT {D}, 'sonde_oxygen_mgL', ts, oxygen_mgl FROM scalup
UNION ALL SELECT {D}, 'sonde_pH', ts, ph FROM scalup
UNION ALL SELECT {D}, CASE WHEN {D} = 'd7' THEN 'par_raw' ELSE 'par_umol_m2_s' END, ts, CASE WHEN {D} = 'd7' THEN par_raw ELSE par_umol_m2_s END FROM par
UNION ALL SELECT {D}, 'hobo_oxygen_' || location, ts, oxygen_mgl FROM hobo UNION ALL SELECT {D}, 'hobo_temp_' || location, ts, temp_degc FROM hobo
UNION ALL SELECT {D}, 'hobo_diff_' || location, ts, diff_mgl FROM hobo_diff"""


@query("DOM21", f"{D} series ts scaled:7", f"SELECT {D}, series, ts, CASE WHEN series LIKE 'mass%' THEN value * 1e12 ELSE value END AS scaled FROM ({MEASURED})")
def measurement_view(spark, d):
    rows = views.measurements(standin.streams(spark, d), MASSES)
    return rows.withColumn("scaled", F.when(F.col("series").startswith("mass"), F.col("value") * 1e12).otherwise(F.col("value")))


@query("DOM22", f"{D} series ts scaled:7", f"""
SELECT {D}, 'turbo_speed_hz' AS series, ts, turbo_speed_hz AS scaled FROM status UNION ALL SELECT {D}, 'turbo_power_w', ts, turbo_power_w FROM status
UNION ALL SELECT {D}, 'turbo_etemp_c', ts, turbo_etemp_c FROM status UNION ALL SELECT {D}, 'turbo_btemp_c', ts, turbo_btemp_c FROM status
UNION ALL SELECT {D}, 'turbo_mtemp_c', ts, turbo_mtemp_c FROM status UNION ALL SELECT {D}, 'pump_rpm', ts, pump_rpm FROM status
UNION ALL SELECT {D}, 'total_pressure_torr', ts, raw_total_pressure_current * 1e-16 / 1.34e-5 * 1e12 FROM status
UNION ALL SELECT {D}, 'voltage_v', ts, voltage_v FROM system_health UNION ALL SELECT {D}, 'current_a', ts, current_a FROM system_health
UNION ALL SELECT {D}, 'teensy_temp_c', ts, teensy_temp_c FROM system_health""")
def status_view(spark, d):
    rows = views.status_series(standin.streams(spark, d, "status", "system_health"))
    return rows.withColumn("scaled", F.when(F.col("series") == "total_pressure_torr", F.col("value") * 1e12).otherwise(F.col("value")))


def _context(stream: str) -> str:
    return f"""SELECT r.*, w.chamber, w.experiment_number, trunc((epoch_us(r.ts) - epoch_us(w.window_start)) / 1e6) < 60 AS settled_out,
  trunc((epoch_us(r.ts) - epoch_us(w.window_start) + w.elapsed_us) / 1e6) / 60 AS elapsed_min
  FROM {stream} r ASOF JOIN cycles0 w ON r.{D} = w.{D} AND r.ts >= w.window_start WHERE r.ts < w.window_end"""


CTES["rga_ctx"] = _context("rga")
VIEW = f"{D}, experiment_number, chamber, settled_out, ts, elapsed_min"


@query("DOM23", f"{VIEW.replace(',', '').replace('elapsed_min', 'elapsed_min:5')} variable scaled:7", f"""
SELECT {VIEW}, 'mass_' || mass AS variable, current / near AS scaled
FROM ({nearest('(SELECT * FROM rga_ctx WHERE mass <> 40)', '(SELECT * FROM rga_ctx WHERE mass = 40)', 'current', D + ', experiment_number')}) WHERE near <> 0
UNION ALL {' UNION ALL '.join(f"SELECT {VIEW}, '{n}', {c} FROM ({_context('scalup')})" for n, c in views.SONDE.items())}
UNION ALL {' UNION ALL '.join(f"SELECT {VIEW}, '{n}', {c} FROM ({_context('status')})" for n, c in views.STATUS.items())}
UNION ALL SELECT {VIEW}, 'total_pressure_amps', raw_total_pressure_current FROM ({_context('status')})
UNION ALL SELECT {VIEW}, 'total_pressure_torr', raw_total_pressure_current * 1e-16 / 1.34e-5 * 1e12 FROM ({_context('status')})""")
def reading_view(spark, d):
    rows = views.experiment_readings(standin.streams(spark, d))
    v = F.col("variable")
    return rows.withColumn("scaled", F.when(v == "total_pressure_amps", F.col("value") * 1e16).when(v == "total_pressure_torr", F.col("value") * 1e12).otherwise(F.col("value")))


LINES = ["temp_degC", "sal_PSU", "pressure_mbar", "oxygen_mgL", "pH", "turbo_speed_hz", "turbo_power_w", "water_pump_rpm"]


@query("DOM24", f"{D} experiment_number chamber variable slope:5 x0:5 y0:7 x1:5 y1:7 n", f"""
SELECT {D}, experiment_number, chamber, variable, slope, x0, slope * x0 + b AS y0, x1, slope * x1 + b AS y1, n FROM (
  SELECT {D}, experiment_number, chamber, variable, regr_slope(y, x) AS slope, regr_intercept(y, x) AS b, min(x) AS x0, max(x) AS x1, count(*) AS n FROM (
    {' UNION ALL '.join(f"SELECT {D}, experiment_number, chamber, trunc(elapsed_us / 1e6) / 60 AS x, {v} AS y, '{v}' AS variable FROM layer_c" for v in LINES)})
  WHERE y IS NOT NULL GROUP BY ALL HAVING count(DISTINCT x) > 1)""")
def line_view(spark, d):
    return views.experiment_lines(layer_c(spark, d), LINES)


@query("DOM25", f"{D} experiment_number chamber experiment_start kind variable value:4@1000", f"""
WITH kept AS (SELECT {D}, experiment_number FROM spans60 WHERE experiment_start BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'), rates_all AS (
  SELECT {D}, experiment_number, chamber, variable, min(t) AS experiment_start, regr_slope(y, x) AS value FROM (
    SELECT {D}, experiment_number, chamber, trunc(elapsed_us / 1e6) / 60 AS x, y, variable, "timestamp" AS t FROM (
      {' UNION ALL '.join(f'''SELECT {D}, experiment_number, chamber, elapsed_us, "timestamp", {v} AS y, '{v}' AS variable FROM layer_c''' for v in ['total_pressure_amps', 'total_pressure_torr', *LINES])}
      UNION ALL {' UNION ALL '.join(f'''SELECT {D}, experiment_number, chamber, elapsed_us, "timestamp", CASE WHEN mass_40_avg <> 0 THEN mass_{m}_avg / mass_40_avg END, 'mass_{m}' FROM layer_c''' for m in MASSES if m != 40)}))
  WHERE y IS NOT NULL GROUP BY ALL HAVING count(DISTINCT x) > 1)
SELECT {D}, experiment_number, chamber, experiment_start, 'rate' AS kind, variable, value FROM rates_all SEMI JOIN kept USING ({D}, experiment_number)
UNION ALL SELECT {D}, experiment_number, chamber, experiment_start, 'flux', variable, output_value FROM fluxes SEMI JOIN kept USING ({D}, experiment_number)""")
def across_view(spark, d):
    bounds = standin.deployments(spark, d).select(D, F.lit("2024-01-05").cast("timestamp_ntz").alias("lo"), F.lit("2024-01-25").cast("timestamp_ntz").alias("hi"))
    return views.across_experiments(staged_layer_c(spark, d), bounds, MASSES)


PLACED_SPEC = METAB_SPEC.replace("mmol_m2_h:4", "mmol_m2_h:5@edge")


@query("DOM26", f"{PLACED_SPEC} h_ion_flux:6@1000000", f"""
SELECT m.*, h.h_ion_flux FROM (SELECT * FROM metab WHERE par_chamber_umol_m2_s IS NOT NULL) m
LEFT JOIN (SELECT {D}, experiment_number, chamber, output_value AS h_ion_flux FROM fluxes WHERE variable = 'h_ion') h USING ({D}, experiment_number, chamber)""")
def metabolism_view(spark, d):
    out = recomputed(spark, d)
    return views.metabolism_points(write_and_read(out["metabolism"]), out["fluxes"])


@query("DOM26_light", f"{D} experiment_number chamber experiment_start par_chamber_umol_m2_s:4 ncp_mmol_m2_h:5@edge gpp_mmol_m2_h:5@edge r2:5", f"""
SELECT * FROM metab_lr WHERE used AND period = 'light' UNION ALL BY NAME SELECT * FROM metab WHERE used AND period = 'light'""")
def light_view(spark, d):
    """Light incubations of the light-response series and of the fluxes from raw streams."""
    series = views.light_incubations(metabolism.classify_o2_fluxes(standin.light_response(spark, d)))
    return series.unionByName(views.light_incubations(recomputed(spark, d)["metabolism"]))


@query("DOM26_transmittance", f"{D} chamber_par_transmittance:6", f"""
SELECT {D}, CASE WHEN {D} IN (SELECT {D} FROM metab_lr) AND substr({D}, 2)::INT % 2 = 0 THEN 0.75 ELSE 1.0 END AS chamber_par_transmittance FROM dep""")
def transmittance_view(spark, d):
    """Transmittance of each deployment's recorded fit: every other one has a fit at 0.75, the others take the default."""
    m = metabolism.classify_o2_fluxes(standin.light_response(spark, d)).where(F.substring(D, 2, 10).cast("int") % 2 == 0)
    return views.saved_transmittance(metabolism.fit_pi_curves(m, 0.75), standin.deployments(spark, d))
