"""Averages on windows, line fits, and light per experiment and day."""

from __future__ import annotations

from pyspark.sql import functions as F

from abyssal import standin
from abyssal.functions.common import write_and_read
from abyssal.functions.scalars import counts_to_amps, counts_to_torr
from abyssal.operators import cycles
from abyssal.operators.aggregate import aggregate_onto_windows, discover_masses, mass_means, stream_means
from abyssal.operators.fluxes import (
    compute_fluxes, concentration_series, daily_max_trend, daily_par, elapsed_minutes, experiment_par, experiment_rates, flux_variable_units,
)
from abyssal.operators.metabolism import classify_o2_fluxes, dark_respiration
from abyssal.operators.stats import line_fit
from abyssal.queries.base import query
from abyssal.queries.ctes import CTES, MASSES, match
from abyssal.queries.sequences import CALIBRATED
from abyssal.schemas import KEY, SCALUP_AVERAGES
from abyssal.sources import loggers

D = KEY
LAYER_SPEC = " ".join(
    [D, "timestamp experiment_number elapsed_s:6@edge chamber", *[f"mass_{m}_avg:4@edge mass_{m}_amps:4@1e16 mass_{m}_torr:4@1e12" for m in MASSES],
     "total_pressure_amps:4@1e16 total_pressure_torr:4@1e12", *[f"{c}:5@edge" for c in SCALUP_AVERAGES], "par_umol_m2_s:5@edge par_raw:5@edge turbo_speed_hz:5@edge turbo_power_w:5@edge water_pump_rpm:5@edge"]
)


def readings(spark, d):
    return standin.streams(spark, d, "rga", "scalup", "status", "par")


def cycles60(spark, d):
    """Cycle windows as a written table, the way the batch hands them on: computed once, size known."""
    return write_and_read(cycles.cycle_windows(standin.valve(spark, d), 60.0))


def layer_c(spark, d):
    return aggregate_onto_windows(cycles60(spark, d), readings(spark, d), MASSES)


def staged_layer_c(spark, d):
    return write_and_read(layer_c(spark, d))


def _means(stream, spark, d):
    windows = cycles60(spark, d)
    return windows.select(D, "window_start").join(
        stream_means(standin.streams(spark, d, *([stream] if stream else [])), windows, MASSES, 1.34e-5, 8.01e-5), [D, "window_start"], "left")


def _from_layer(columns: str) -> str:
    return f'SELECT {D}, "timestamp" AS window_start, {columns} FROM layer_c'


@query("AGG01", f"{D} window_start mass current:4 amps:4@1e16 torr:4@1e12", f"""
SELECT *, current * 1e-16 AS amps, current * 1e-16 / 8.01e-5 AS torr FROM (SELECT {D}, window_start, mass, avg(current) AS current FROM ({match('rga', 'cycles60')}) GROUP BY ALL)""")
def window_mass_means(spark, d):
    rows = mass_means(standin.rga(spark, d), cycles60(spark, d))
    return rows.withColumns({"amps": counts_to_amps(F.col("current")), "torr": counts_to_torr(F.col("current"), 8.01e-5)})


@query("AGG02", f"{D} window_start temp_degC:5@edge sal_PSU:5@edge pressure_mbar:5@edge oxygen_mgL:5@edge pH:5@edge", _from_layer("temp_degC, sal_PSU, pressure_mbar, oxygen_mgL, pH"))
def window_sonde_means(spark, d):
    return _means("scalup", spark, d)


@query("AGG03", f"{D} window_start turbo_speed_hz:5@edge turbo_power_w:5@edge water_pump_rpm:5@edge total_pressure_amps:4@1e16 total_pressure_torr:4@1e12",
       _from_layer("turbo_speed_hz, turbo_power_w, water_pump_rpm, total_pressure_amps, total_pressure_torr"))
def window_status_means(spark, d):
    return _means("status", spark, d)


@query("AGG04", f"{D} window_start par_umol_m2_s:5@edge par_raw:5@edge", _from_layer("par_umol_m2_s, par_raw"))
def window_light_means(spark, d):
    return _means("par", spark, d)


@query("AGG05", LAYER_SPEC, "SELECT * FROM layer_c")
def cycle_averages(spark, d):
    return layer_c(spark, d)


@query("JN09", LAYER_SPEC, "SELECT * FROM layer_b")
def scan_averages(spark, d):
    """The same aggregation on the scan grain; the four streams meet in one conditional aggregate."""
    scans = write_and_read(cycles.attach_chamber_context(cycles.scan_windows(standin.rga(spark, d)), cycles60(spark, d)))
    return aggregate_onto_windows(scans, readings(spark, d), MASSES)


FIT = 'SELECT deployment_id, experiment_number, chamber, trunc(elapsed_us / 1e6) / 60 AS x, {} AS y, "timestamp" AS t FROM layer_c'


@query("AGG06", f"{D} experiment_number chamber experiment_start slope:6 r2:5 n", f"""
SELECT {D}, experiment_number, chamber, min(t) AS experiment_start, regr_slope(y, x) AS slope, regr_r2(y, x) AS r2, count(*) AS n
FROM ({FIT.format('temp_degC')}) WHERE y IS NOT NULL GROUP BY ALL HAVING count(DISTINCT x) > 1""")
def series_fit(spark, d):
    return concentration_series(layer_c(spark, d), "temp_degC")


@query("AGG07", f"{D} experiment_number chamber slope:6 intercept:5", f"""
SELECT {D}, experiment_number, chamber, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept
FROM ({FIT.format('mass_28_avg')}) WHERE y IS NOT NULL GROUP BY ALL HAVING count(DISTINCT x) > 1""")
def linear_fits(spark, d):
    return line_fit(layer_c(spark, d), [D, "experiment_number", "chamber"], elapsed_minutes(), F.col("mass_28_avg"))


@query("AGG08", f"{D} event_type slope:6 intercept:5 r2:6 n", f"""
SELECT {D}, event_type, regr_slope(value, k) AS slope, regr_intercept(value, k) AS intercept, regr_r2(value, k) AS r2, count(*) AS n FROM ev GROUP BY ALL HAVING count(DISTINCT k) > 1""")
def ols(spark, d):
    return line_fit(standin.events(spark, d), [D, "event_type"], F.col("k").cast("double"), F.col("value"))


RATE_VARIABLES = ["temp_degC", "sal_PSU", "oxygen_mgL", "pH", "turbo_speed_hz"]
CTES["rates"] = f"""
SELECT {D}, experiment_number, chamber, variable, min(t) AS experiment_start, regr_slope(y, x) AS rate, regr_intercept(y, x) AS intercept, count(*) AS n FROM (
{' UNION ALL '.join(f"SELECT *, '{v}' AS variable FROM ({FIT.format(v)})" for v in RATE_VARIABLES)} UNION ALL
{' UNION ALL '.join(f"SELECT *, 'mass_{m}' AS variable FROM ({FIT.format(f'CASE WHEN mass_40_avg <> 0 THEN mass_{m}_avg / mass_40_avg END')})" for m in MASSES if m != 40)})
WHERE y IS NOT NULL GROUP BY ALL HAVING count(DISTINCT x) > 1"""


@query("AGG09", f"{D} experiment_number chamber variable experiment_start rate:5", "SELECT * FROM rates")
def rates(spark, d):
    return experiment_rates(layer_c(spark, d), MASSES, RATE_VARIABLES)


@query("AGG10", f"{D} experiment_number par_mean_umol_m2_s:4 par_integrated_mol_m2:6 par_coverage:6", "SELECT * FROM exp_par")
def light_per_experiment(spark, d):
    s = cycles.experiment_spans(cycles60(spark, d), 60.0)
    return experiment_par(standin.par(spark, d), s)


@query("AGG11", f"{D} day n_readings coverage:6 dli_mol_m2_d:6 max_par_umol_m2_s:4", "SELECT *, date::VARCHAR AS day FROM par_daily")
def light_per_day(spark, d):
    return daily_par(standin.par(spark, d)).withColumn("day", F.col("date").cast("string"))


@query("AGG12", f"{D} slope_umol_m2_s_per_day:5 intercept_umol_m2_s:4 pct_per_day:5 r2:6 n_days first_day", f"""
SELECT {D}, regr_slope(m, x) AS slope_umol_m2_s_per_day, regr_intercept(m, x) AS intercept_umol_m2_s, 100 * regr_slope(m, x) / avg(m) AS pct_per_day,
       regr_r2(m, x) AS r2, count(*) AS n_days, min(date)::VARCHAR AS first_day
FROM (SELECT {D}, date, max_par_umol_m2_s AS m, date_diff('day', min(date) OVER (PARTITION BY {D}), date) AS x FROM par_daily
      WHERE coverage >= 0.5 AND max_par_umol_m2_s IS NOT NULL) GROUP BY ALL HAVING count(*) > 1""")
def light_trend(spark, d):
    return daily_max_trend(daily_par(standin.par(spark, d)), 0.5).withColumn("first_day", F.col("first_date").cast("string"))


@query("AGG13", f"{D} interval_s:6", f"SELECT DISTINCT {D}, interval_s FROM ({CALIBRATED})")
def intervals(spark, d):
    return loggers.logging_interval(loggers.read_par_rows(loggers.scan_csv_text(spark, standin.archive(spark, d, "exports"))))


@query("AGG14", f"{D} chamber r_dark_mmol_m2_h:4", f"""
SELECT {D}, chamber, -avg(o2) AS r_dark_mmol_m2_h FROM metab_lr WHERE used AND period = 'dark' GROUP BY ALL""")
def respiration(spark, d):
    return dark_respiration(classify_o2_fluxes(standin.light_response(spark, d)))


@query("AGG24", "variable output_unit", "SELECT DISTINCT variable, output_unit FROM fluxes")
def units(spark, d):
    return flux_variable_units(compute_fluxes(staged_layer_c(spark, d)))


@query("SCF16", "mass n", "SELECT mass, count(*) AS n FROM rga GROUP BY ALL")
def masses_present(spark, d):
    """Masses are discovered first, then counted as explicit columns and unpivoted again."""
    rga = standin.rga(spark, d)
    found = discover_masses(rga)
    wide = rga.agg(*[F.count_if(F.col("mass") == m).alias(str(m)) for m in found])
    return wide.unpivot([], [str(m) for m in found], "mass", "n").withColumn("mass", F.col("mass").cast("bigint"))
