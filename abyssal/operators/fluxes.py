"""Benthic fluxes from cycle averages, and light per experiment and per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import as_col, safe_div, seconds_between, whole_minutes
from abyssal.functions.exact import FINE, exact_avg, exact_sum, mean_of_sums, merged_sums, partial_sums, sum_of_sums
from abyssal.functions.scalars import at_most, hydrogen_ion, ratio_or_null
from abyssal.functions.seawater import gas_solubility, seawater_density
from abyssal.operators.asof import match_to_windows
from abyssal.operators.intervals import elementary_intervals
from abyssal.operators.stats import line_fit
from abyssal.schemas import ARGON, DEFAULTS, KEY

GROUP = ["experiment_number", "chamber"]
# Native unit to mmol/L per variable (None: a bare rate), and the output units.
TO_MMOL_PER_L = {"oxygen": 1 / 1000 * 1 / 32 * 1000, "h_ion": 1000.0, "n2_denitrification": 1e-3, "temp_degC": None}
FLUX_UNIT, RATE_UNIT = "mmol m-2 h-1", "degC h-1"
MINUTES_PER_HOUR = 60.0
LITRES_PER_M3 = 1000.0
SECONDS_PER_DAY = 86_400


def elapsed_minutes() -> Column:
    return whole_minutes(F.col("elapsed_us"))


def concentration_series(cycles: DataFrame, value: str | Column, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Line fit of a value on elapsed minutes per experiment and chamber, with the first time used."""
    y = F.col(value) if isinstance(value, str) else value
    return line_fit(cycles, [*keys, *GROUP], elapsed_minutes(), y, F.min("timestamp").alias("experiment_start")).drop("intercept")


def dissolved_n2(cycles: DataFrame, sensitivity_ratio: float | str | Column = 1.0, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Cycles with argon, plus dissolved N2 (umol/L) from the mass 28 to 40 ratio.

    The argon term is fixed by temperature and salinity of the experiment's first cycle having both: the
    chamber is sealed, so drift in temperature must not look like N2.
    """
    group = [*keys, *GROUP]
    usable = cycles.where(F.col(f"mass_{ARGON}_avg") != 0)
    complete = F.col("temp_degC").isNotNull() & F.col("sal_PSU").isNotNull()
    anchor = usable.groupBy(*group).agg(
        F.min_by(F.struct("temp_degC", "sal_PSU"), F.when(complete, F.col("timestamp"))).alias("__anchor")
    )
    t0, s0 = F.col("__anchor.temp_degC"), F.col("__anchor.sal_PSU")
    ratio = F.col("mass_28_avg") / F.col(f"mass_{ARGON}_avg") / as_col(sensitivity_ratio)
    n2 = ratio * gas_solubility("Ar", t0, s0) * seawater_density(t0, s0)
    return usable.join(anchor, group, "left").withColumn("n2_umol_l", n2).drop("__anchor")


def flux_inputs(cycles: DataFrame, sensitivity_ratio: float | str | Column, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Long (variable, value) rows of everything a flux is fitted to; absent sources are skipped."""
    base = [*keys, *GROUP, "timestamp", "elapsed_us"]
    have = {c.lower() for c in cycles.columns}
    direct = {"oxygen": F.col("oxygen_mgL"), "h_ion": hydrogen_ion(F.col("pH")), "temp_degC": F.col("temp_degC")}
    needs = {"oxygen": "oxygen_mgl", "h_ion": "ph", "temp_degC": "temp_degc"}
    pairs = [F.struct(F.lit(n).alias("variable"), c.alias("value")) for n, c in direct.items() if needs[n] in have]
    long = cycles.select(*base, F.explode(F.array(*pairs)).alias("__v")).select(*base, "__v.variable", "__v.value")
    if {"mass_28_avg", f"mass_{ARGON}_avg", "temp_degc", "sal_psu"} <= have:
        n2 = dissolved_n2(cycles, sensitivity_ratio, keys)
        long = long.unionByName(n2.select(*base, F.lit("n2_denitrification").alias("variable"), F.col("n2_umol_l").alias("value")))
    return long


def compute_fluxes(
    cycles: DataFrame,
    volume_l: float | str | Column = DEFAULTS["chamber_volume_l"],
    area_m2: float | str | Column = DEFAULTS["chamber_area_m2"],
    sensitivity_ratio: float | str | Column = 1.0,
    keys: Sequence[str] = (KEY,),
) -> DataFrame:
    """Signed fluxes of oxygen, H+ and N2 and the temperature rate: one fit per variable in one aggregate.

    Geometry may be numbers or columns that are constant per key (several parameter sets in one job).
    """
    for name, v in (("chamber volume", volume_l), ("chamber area", area_m2), ("sensitivity ratio", sensitivity_ratio)):
        if isinstance(v, (int, float)) and v <= 0:
            raise ValueError(f"{name} must be positive")
    extra = [c for c in (volume_l, area_m2) if isinstance(c, str)]
    fits = line_fit(
        flux_inputs(cycles, sensitivity_ratio, [*keys, *extra]),
        [*keys, *extra, *GROUP, "variable"],
        elapsed_minutes(),
        F.col("value"),
        F.min("timestamp").alias("experiment_start"),
    )
    slope = F.col("slope")
    factor = F.lit(None).cast("double")
    for name, f in TO_MMOL_PER_L.items():
        if f is not None:
            factor = F.when(F.col("variable") == name, F.lit(f)).otherwise(factor)
    per_area = as_col(volume_l) / as_col(area_m2)
    is_rate = F.col("variable") == "temp_degC"
    output = F.when(is_rate, slope * MINUTES_PER_HOUR).otherwise(slope * factor * per_area * MINUTES_PER_HOUR)
    return fits.select(
        *keys, *GROUP, "experiment_start", "variable", slope.alias("slope_native_per_min"), "r2",
        F.col("n").alias("n_points"), output.alias("output_value"),
        F.when(is_rate, F.lit(RATE_UNIT)).otherwise(F.lit(FLUX_UNIT)).alias("output_unit"),
    )


def chamber_geometry(params: DataFrame) -> DataFrame:
    """Complete volume and height from the area plus one of them, naming what is wrong instead of failing."""
    v, a, h = F.col("chamber_volume_l"), F.col("chamber_area_m2"), F.col("chamber_height_m")
    given = F.coalesce(v, h)
    problem = (
        F.when(v.isNull() == h.isNull(), F.lit("give exactly one of chamber_volume_l or chamber_height_m"))
        .when(~F.coalesce(a > 0, F.lit(False)), F.lit("chamber_area_m2 must be positive"))
        .when(~(given > 0), F.when(h.isNotNull(), F.lit("chamber_height_m must be positive")).otherwise(F.lit("chamber_volume_l must be positive")))
    )
    checked = params.withColumn("problem", problem)
    ok = F.col("problem").isNull()
    return checked.withColumns(
        {
            "chamber_geometry_from": F.when(h.isNull(), F.lit("volume")).otherwise(F.lit("height")),
            "chamber_volume_l": F.when(ok, F.coalesce(v, h * a * LITRES_PER_M3)),
            "chamber_height_m": F.when(ok, F.coalesce(h, safe_div(v, a) / LITRES_PER_M3)),
        }
    )


def experiment_par(par: DataFrame, spans: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Mean and integrated PAR over each sealed incubation and the part of it that was logged."""
    windows = spans.select(
        *keys, "experiment_number", F.col("experiment_start").alias("window_start"), F.col("experiment_end").alias("window_end")
    )
    lit = par.where("par_umol_m2_s IS NOT NULL").select(*keys, "ts", "par_umol_m2_s", "interval_s")
    inside = match_to_windows(lit, windows, keys)
    logged = F.coalesce(exact_sum("interval_s"), F.lit(0.0))
    span_s = F.first(seconds_between(F.col("window_start"), F.col("window_end")))
    return inside.groupBy(*keys, "experiment_number").agg(
        exact_avg("par_umol_m2_s").alias("par_mean_umol_m2_s"),
        (F.coalesce(exact_sum(F.col("par_umol_m2_s") * F.col("interval_s")), F.lit(0.0)) / 1e6).alias("par_integrated_mol_m2"),
        at_most(safe_div(logged, span_s), 1.0).alias("par_coverage"),
    )


def experiment_par_over_sets(par: DataFrame, spans: DataFrame, set_key: str, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """`experiment_par` for the spans of many parameter sets, each light reading added up once per elementary interval."""
    keys = list(keys)
    windows = spans.select(*keys, set_key, "experiment_number", F.col("experiment_start").alias("window_start"), F.col("experiment_end").alias("window_end"))
    cuts, members = elementary_intervals(windows, keys, set_key)
    lit = par.where("par_umol_m2_s IS NOT NULL").select(*keys, "ts", "par_umol_m2_s", "interval_s")
    values = {"light": F.col("par_umol_m2_s"), "dose": F.col("par_umol_m2_s") * F.col("interval_s"), "logged": F.col("interval_s")}
    sums = match_to_windows(lit, cuts, keys).groupBy(*keys, F.col("window_start").alias("cut_start")).agg(
        *[c for n, v in values.items() for c in partial_sums(n, v, FINE)])
    per_set = members.join(sums, [*keys, "cut_start"]).groupBy(*keys, set_key, "window_start").agg(*[c for n in values for c in merged_sums(n, FINE)])
    span_s = seconds_between(F.col("window_start"), F.col("window_end"))
    return windows.join(per_set, [*keys, set_key, "window_start"]).select(
        *keys, set_key, "experiment_number", mean_of_sums("light", FINE).alias("par_mean_umol_m2_s"),
        (F.coalesce(sum_of_sums("dose", FINE), F.lit(0.0)) / 1e6).alias("par_integrated_mol_m2"),
        at_most(safe_div(F.coalesce(sum_of_sums("logged", FINE), F.lit(0.0)), span_s), 1.0).alias("par_coverage"),
    )


def attach_experiment_par(
    fluxes: DataFrame, par: DataFrame, spans: DataFrame, keys: Sequence[str] = (KEY,), light: DataFrame | None = None
) -> DataFrame:
    return fluxes.join(experiment_par(par, spans, keys) if light is None else light, [*keys, "experiment_number"], "left")


def daily_par(par: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Per UTC day: readings, logged part of the day, daily light integral and maximum (null uncalibrated)."""
    value, interval = F.col("par_umol_m2_s"), F.col("interval_s")
    logged = F.coalesce(exact_sum(interval), F.lit(0.0)) / SECONDS_PER_DAY
    dli = F.coalesce(exact_sum(value * interval), F.lit(0.0)) / 1e6
    return par.groupBy(*keys, F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.least(logged, F.lit(1.0)).alias("coverage"),
        F.when(F.count(value) > 0, dli).alias("dli_mol_m2_d"),
        F.max(value).alias("max_par_umol_m2_s"),
    )


def daily_max_trend(daily: DataFrame, min_coverage: float = DEFAULTS["min_par_coverage"], keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Line fit of the daily maximum over full days: slope, percent of the mean per day, r2, days used."""
    full = daily.where((F.col("coverage") >= min_coverage) & F.col("max_par_umol_m2_s").isNotNull())
    # The fit is on days since a fixed date; moving the origin to the first full day changes the intercept only.
    day = F.datediff("date", F.lit("2000-01-01").cast("date")).cast("double")
    fit = line_fit(full, keys, day, F.col("max_par_umol_m2_s"), F.min("date").alias("first_date"),
                   F.min(day).alias("__d0"), exact_avg("max_par_umol_m2_s").alias("__mean"), exact_avg(day).alias("__dm"))
    slope = F.col("slope")
    return fit.select(
        *keys,
        slope.alias("slope_umol_m2_s_per_day"),
        (F.col("__mean") - slope * (F.col("__dm") - F.col("__d0"))).alias("intercept_umol_m2_s"),
        F.when(F.col("__mean") != 0, 100 * slope / F.col("__mean")).alias("pct_per_day"),
        "r2",
        F.col("n").alias("n_days"),
        "first_date",
    )


def experiment_rates(cycles: DataFrame, masses: Sequence[int], variables: Sequence[str], keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Rate of change per experiment and chamber of every variable; masses are taken over argon."""
    values = {f"mass_{m}": ratio_or_null(F.col(f"mass_{m}_avg"), F.col(f"mass_{ARGON}_avg")) for m in masses if m != ARGON}
    values |= {v: F.col(v) for v in variables}
    pairs = F.array(*[F.struct(F.lit(n).alias("variable"), c.alias("value")) for n, c in values.items()])
    base = [*keys, *GROUP, "timestamp", "elapsed_us"]
    long = cycles.select(*base, F.explode(pairs).alias("__v")).select(*base, "__v.variable", "__v.value")
    return line_fit(long, [*keys, *GROUP, "variable"], elapsed_minutes(), F.col("value"), F.min("timestamp").alias("experiment_start")).select(
        *keys, *GROUP, "variable", "experiment_start", F.col("slope").alias("rate"), "intercept", "n"
    )


def flux_variable_units(fluxes: DataFrame) -> DataFrame:
    return fluxes.select("variable", "output_unit").distinct()
