"""The tables behind each interactive page, for all deployments and experiments at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import whole_minutes, write_and_read
from abyssal.functions.scalars import counts_to_amps, counts_to_torr, current_in_unit
from abyssal.operators.aggregate import experiment_context
from abyssal.operators.cycles import cycle_windows, experiment_starts
from abyssal.operators.fluxes import compute_fluxes, elapsed_minutes, experiment_rates
from abyssal.operators.metabolism import fit_pi_curves
from abyssal.operators.ranges import experiments_in_range, keep_experiments
from abyssal.operators.ratios import mesocosm_difference, ratio_to_mass, wide_ratio_to_mass
from abyssal.operators.stats import line_fit
from abyssal.schemas import DEFAULTS, KEY

SONDE = {"temp_degC": "temp_degc", "sal_PSU": "sal_psu", "pressure_mbar": "pressure_mbar", "oxygen_mgL": "oxygen_mgl", "pH": "ph"}
STATUS = {"turbo_speed_hz": "turbo_speed_hz", "turbo_power_w": "turbo_power_w", "water_pump_rpm": "pump_rpm"}
CYCLE_VARIABLES = ["total_pressure_amps", "total_pressure_torr", *SONDE, *STATUS]


def _series(df: DataFrame, name: str | Column, value: Column, ts: str = "ts") -> DataFrame:
    label = F.lit(name) if isinstance(name, str) else name
    return df.select(KEY, label.alias("series"), F.col(ts).alias("ts"), value.cast("double").alias("value"))


def _all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _columns_as_series(df: DataFrame, columns: dict[str, Column], prefix: str) -> DataFrame:
    """Several columns of one table in one pass."""
    cells = F.explode(F.array(*[F.struct(F.lit(prefix + n).alias("series"), c.cast("double").alias("value")) for n, c in columns.items()]))
    return df.select(KEY, "ts", cells.alias("c")).select(KEY, "c.series", "ts", "c.value")


def light_series(par: DataFrame) -> DataFrame:
    """Calibrated PAR, or raw counts for a deployment without any calibrated reading."""
    known = par.groupBy(KEY).agg((F.count("par_umol_m2_s") > 0).alias("__calibrated"))
    rows = par.join(known, KEY)
    return _series(
        rows, F.when(F.col("__calibrated"), "par_umol_m2_s").otherwise("par_raw"),
        F.when(F.col("__calibrated"), F.col("par_umol_m2_s")).otherwise(F.col("par_raw")),
    )


def measurements(
    tables: dict[str, DataFrame], masses: Sequence[int], unit: str = "torr", averaged: bool = False,
    sensitivity: float = DEFAULTS["partial_pressure_sensitivity_a_per_torr"],
) -> DataFrame:
    """One long (series, ts, value) frame: masses in the unit (full or averaged), ratios, sonde, light, oxygen loggers."""
    if averaged:
        table = tables["chamber_cycles"]
        suffix = "avg" if unit == "raw" else unit
        wide = table.select(KEY, F.col("timestamp").alias("ts"), *[F.col(f"mass_{m}_{suffix}").alias(f"mass_{m}") for m in masses])
        current = wide.unpivot([KEY, "ts"], [f"mass_{m}" for m in masses], "series", "value").select(KEY, "series", "ts", "value")
        ratio = wide_ratio_to_mass(table, masses, "timestamp")
    else:
        rga = tables["rga"].where(F.col("mass").isin(*masses))
        current = _series(rga, F.concat(F.lit("mass_"), F.col("mass").cast("string")), current_in_unit(F.col("current"), unit, sensitivity))
        ratio = ratio_to_mass(rga)
    hobo = tables["hobo_oxygen"]
    by_place = lambda p: F.concat(F.lit(p), F.col("location"))
    return _all([
        current,
        _series(ratio, F.concat(F.lit("ratio_"), F.col("mass").cast("string")), F.col("ratio")),
        _columns_as_series(tables["scalup"], {n: F.col(c) for n, c in SONDE.items()}, "sonde_"),
        light_series(tables["par"]),
        _series(hobo, by_place("hobo_oxygen_"), F.col("oxygen_mgl")),
        _series(hobo, by_place("hobo_temp_"), F.col("temp_degc")),
        _series(mesocosm_difference(hobo), by_place("hobo_diff_"), F.col("diff_mgl")),
    ])


def status_series(tables: dict[str, DataFrame], sensitivity: float = DEFAULTS["total_pressure_sensitivity_a_per_torr"]) -> DataFrame:
    """Pump, temperatures, total pressure and supply health as one long frame."""
    names = ["turbo_speed_hz", "turbo_power_w", "turbo_etemp_c", "turbo_btemp_c", "turbo_mtemp_c", "pump_rpm"]
    status = {n: F.col(n) for n in names} | {"total_pressure_torr": counts_to_torr(F.col("raw_total_pressure_current"), sensitivity)}
    health = {n: F.col(n) for n in ("voltage_v", "current_a", "teensy_temp_c")}
    return _all([_columns_as_series(tables["status"], status, ""), _columns_as_series(tables["system_health"], health, "")])


def experiment_readings(
    tables: dict[str, DataFrame], settle_s: float = DEFAULTS["settle_offset_s"],
    total_pressure_sensitivity: float = DEFAULTS["total_pressure_sensitivity_a_per_torr"], experiments: DataFrame | None = None,
) -> DataFrame:
    """Every reading inside an experiment: variable, own elapsed minutes, chamber, settled-out flag, value.

    Masses are over the nearest argon reading of the same experiment.
    """
    windows = cycle_windows(tables["valve"], 0.0)
    if experiments is not None:
        windows = keep_experiments(windows, experiments)
    # written once: every stream, and both sides of the ratio, would label the transitions again
    windows = write_and_read(windows)
    group = [KEY, "experiment_number"]
    minutes = whole_minutes(F.col("elapsed_us")).alias("elapsed_min")
    context = [*group, "chamber", "settled_out", "ts", minutes]

    rga = write_and_read(experiment_context(tables["rga"].select(KEY, "ts", "mass", "current", "pos"), windows, settle_s))
    ratio = ratio_to_mass(rga, keys=group).select(
        *context, F.concat(F.lit("mass_"), F.col("mass").cast("string")).alias("variable"), F.col("ratio").alias("value")
    )

    def variables(stream: str, columns: dict[str, Column]) -> DataFrame:
        rows = experiment_context(tables[stream], windows, settle_s)
        cells = F.explode(F.array(*[F.struct(F.lit(n).alias("variable"), c.alias("value")) for n, c in columns.items()]))
        return rows.select(*context, cells.alias("c")).select(*group, "chamber", "settled_out", "ts", "elapsed_min", "c.variable", "c.value")

    raw = F.col("raw_total_pressure_current")
    pump = {n: F.col(c) for n, c in STATUS.items()} | {
        "total_pressure_amps": counts_to_amps(raw), "total_pressure_torr": counts_to_torr(raw, total_pressure_sensitivity)
    }
    return _all([ratio, variables("scalup", {n: F.col(c) for n, c in SONDE.items()}), variables("status", pump)])


def experiment_lines(cycles: DataFrame, variables: Sequence[str] = CYCLE_VARIABLES) -> DataFrame:
    """Fit line per experiment, chamber and variable over its cycle averages, with both end points to draw it."""
    base = [KEY, "experiment_number", "chamber", "elapsed_us"]
    cells = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("value")) for v in variables]))
    long = cycles.select(*base, cells.alias("c")).select(*base, "c.variable", "c.value")
    x = elapsed_minutes()
    fit = line_fit(long, [KEY, "experiment_number", "chamber", "variable"], x, F.col("value"), F.min(x).alias("x0"), F.max(x).alias("x1"))
    at = lambda c: F.col("slope") * F.col(c) + F.col("intercept")
    return fit.select(KEY, "experiment_number", "chamber", "variable", "slope", "intercept", "x0", at("x0").alias("y0"), "x1", at("x1").alias("y1"), "n")


def across_experiments(cycles: DataFrame, bounds: DataFrame, masses: Sequence[int], settle_s: float = DEFAULTS["settle_offset_s"]) -> DataFrame:
    """Rates and fluxes of the experiments starting in range, over their start."""
    starts = experiment_starts(cycles, "timestamp", settle_s=settle_s)
    kept = keep_experiments(cycles, experiments_in_range(starts, bounds))
    rates = experiment_rates(kept, masses, CYCLE_VARIABLES).select(
        KEY, "experiment_number", "chamber", "experiment_start", F.lit("rate").alias("kind"), "variable", F.col("rate").alias("value"))
    fluxes = compute_fluxes(kept).select(
        KEY, "experiment_number", "chamber", "experiment_start", F.lit("flux").alias("kind"), "variable", F.col("output_value").alias("value"))
    return rates.unionByName(fluxes)


def metabolism_points(metabolism: DataFrame, fluxes: DataFrame) -> DataFrame:
    """Oxygen fluxes placed on the light axis, with the H+ flux of the same experiment and chamber where there is one."""
    placed = metabolism.where("par_chamber_umol_m2_s IS NOT NULL")
    return placed.join(hydrogen_with_points(metabolism, fluxes).select(KEY, "experiment_number", "chamber", "h_ion_flux"),
                       [KEY, "experiment_number", "chamber"], "left")


def hydrogen_with_points(metabolism: DataFrame, fluxes: DataFrame) -> DataFrame:
    h = fluxes.where("variable = 'h_ion'").select(KEY, "experiment_number", "chamber", F.col("output_value").alias("h_ion_flux"))
    return h.join(metabolism.where("par_chamber_umol_m2_s IS NOT NULL"), [KEY, "experiment_number", "chamber"], "inner")


def light_incubations(metabolism: DataFrame) -> DataFrame:
    return metabolism.where("used AND period = 'light'").select(
        KEY, "experiment_number", "chamber", "experiment_start", "par_chamber_umol_m2_s", "ncp_mmol_m2_h", "gpp_mmol_m2_h", "r2")


def refit_in_range(metabolism: DataFrame, bounds: DataFrame, transmittance: float = 1.0) -> DataFrame:
    """Curves over the experiments starting in range; respiration in GPP stays the whole-deployment mean."""
    return fit_pi_curves(experiments_in_range(metabolism, bounds), transmittance)


def saved_transmittance(pi_fit: DataFrame, deployments: DataFrame) -> DataFrame:
    """The transmittance each deployment's recorded fit was made with, or the default."""
    known = pi_fit.groupBy(KEY).agg(F.first("chamber_par_transmittance").alias("t"))
    return deployments.select(KEY).join(known, KEY, "left").select(
        KEY, F.coalesce("t", F.lit(DEFAULTS["chamber_par_transmittance"])).alias("chamber_par_transmittance"))
