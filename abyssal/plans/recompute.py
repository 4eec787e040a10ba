"""Layers C to E from the raw streams, for one parameter set per deployment or a grid of sets in one job."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import add_seconds, safe_div, write_and_read
from abyssal.operators.aggregate import aggregate_onto_windows, means_over_sets
from abyssal.operators.cycles import cycle_candidates, cycle_windows, experiment_spans
from abyssal.operators.fluxes import attach_experiment_par, compute_fluxes, experiment_par_over_sets
from abyssal.operators.metabolism import classify_o2_fluxes, fit_pi_curves
from abyssal.schemas import DEFAULTS, KEY

PARAMETERS = [k for k in DEFAULTS if k != "par_time_offset_h"]


def with_parameter_sets(df: DataFrame, sets: Sequence[dict[str, float]]) -> DataFrame:
    """Every row once per parameter set (`param_id` 0, 1, ...), missing parameters at their defaults."""
    rows = [
        F.struct(F.lit(i).cast("bigint").alias("param_id"), *[F.lit(float({**DEFAULTS, **s}[p])).alias(p) for p in PARAMETERS])
        for i, s in enumerate(sets)
    ]
    return df.select(*df.columns, F.explode(F.array(*rows)).alias("__p")).select(*df.columns, "__p.*")


def in_torr(table: DataFrame, parameters: DataFrame, masses: Sequence[int], keys: Sequence[str]) -> DataFrame:
    """Divide the Amps standing in the Torr columns by each row's own sensitivities."""
    p = parameters.select(
        *keys, F.col("partial_pressure_sensitivity_a_per_torr").alias("__pp"), F.col("total_pressure_sensitivity_a_per_torr").alias("__tp")
    )
    new = {"total_pressure_torr": safe_div(F.col("total_pressure_torr"), F.col("__tp"))}
    new |= {f"mass_{m}_torr": safe_div(F.col(f"mass_{m}_torr"), F.col("__pp")) for m in masses if f"mass_{m}_torr" in table.columns}
    return table.join(p, list(keys), "left").withColumns(new).drop("__pp", "__tp")


def layers_from_streams(
    streams: dict[str, DataFrame], valve: DataFrame, parameters: DataFrame, masses: Sequence[int],
    keys: Sequence[str] = (KEY,), fit: bool = True, windows: DataFrame | None = None, strategy: str = "auto",
    stage: Callable[[DataFrame, str], DataFrame] | None = None, set_key: str | None = None,
) -> dict[str, DataFrame]:
    """Windows, cycle averages, fluxes with light, metabolism and curve fits.

    `parameters` has one row per `keys` with the parameter columns; every stream and the valve carry the
    keys. One job serves all of them. `windows` may be a written table of the same cycle windows. Each layer is staged
    (written to the shared folder, or by `stage`) before the next one reads it, so readings are matched once. With `set_key`, the
    last of the keys, windows and parameters are those of many sets, while streams have the other keys only and are read once.
    """
    keys = list(keys)
    stage = stage or (lambda df, _: write_and_read(df))
    settle = parameters.select(*keys, "settle_offset_s")
    if windows is None:
        windows = cycle_windows(valve.join(settle, keys), "settle_offset_s", keys)
    spans = experiment_spans(windows.join(settle, keys), "settle_offset_s", [*keys, "settle_offset_s"]).drop("settle_offset_s")
    means = means_over_sets(streams, windows, masses, set_key, keys[:-1], strategy) if set_key else None
    averaged = aggregate_onto_windows(windows, streams, masses, 1.0, 1.0, keys, strategy, means)
    cycles = stage(in_torr(averaged, parameters, masses, keys), "chamber_cycles")
    geometry = parameters.select(*keys, "chamber_volume_l", "chamber_area_m2", "n2_ar_sensitivity_ratio")
    fluxes = compute_fluxes(cycles.join(geometry, keys), "chamber_volume_l", "chamber_area_m2", "n2_ar_sensitivity_ratio", keys)
    light = experiment_par_over_sets(streams["par"], spans, set_key, keys[:-1]) if set_key else None
    fluxes = stage(attach_experiment_par(fluxes, streams["par"], spans, keys, light), "fluxes")
    limits = parameters.select(*keys, "dark_par_threshold_umol_m2_s", "min_par_coverage", "metabolism_min_r2", "chamber_par_transmittance")
    # min_par_coverage and the others are columns here, one value per key.
    metabolism = classify_o2_fluxes(
        fluxes.join(limits, keys), "dark_par_threshold_umol_m2_s", "min_par_coverage", "metabolism_min_r2", "chamber_par_transmittance", keys
    )
    metabolism = stage(metabolism, "metabolism")
    out = {"windows": windows, "spans": spans, "chamber_cycles": cycles, "fluxes": fluxes, "metabolism": metabolism}
    if fit:
        used = limits.select(*keys, "chamber_par_transmittance")
        out["pi_fit"] = stage(fit_pi_curves(metabolism, 1.0, keys).drop("chamber_par_transmittance").join(used, keys), "pi_fit")
    return out


def recompute_grid(tables: dict[str, DataFrame], sets: Sequence[dict[str, float]], masses: Sequence[int], fit: bool = True) -> dict[str, DataFrame]:
    """What-if layers for several parameter sets at once; results carry `param_id`.

    Only tables with a row per deployment, window or flux are copied per set: transitions are labelled once, and readings are
    added up once on the elementary intervals of all sets' windows.
    """
    keys = [KEY, "param_id"]
    parameters = with_parameter_sets(tables["valve"].select(KEY).distinct(), sets)
    whole = write_and_read(cycle_candidates(tables["valve"], 0.0).drop("long_enough", "chunk", "pos"))
    start = add_seconds(F.col("window_start"), F.col("settle_offset_s"))
    windows = whole.join(parameters.select(*keys, "settle_offset_s"), KEY).withColumn("window_start", start).where("window_end > window_start")
    windows = write_and_read(windows.select(*keys, *[c for c in whole.columns if c != KEY]))
    streams = {n: tables[n] for n in ("rga", "scalup", "status", "par")}
    return layers_from_streams(streams, tables["valve"], parameters, masses, keys, fit, windows, set_key="param_id")
