"""Averages of every stream on a grain of windows (scans or cycles), wide and long."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import as_col, micros, whole_seconds
from abyssal.functions.exact import READINGS, cut_columns, exact_avg, exact_avg_where, mean_of_sums, merged_sums, partial_sums
from abyssal.functions.scalars import counts_to_amps, counts_to_torr
from abyssal.operators.asof import match_to_windows
from abyssal.operators.intervals import elementary_intervals
from abyssal.schemas import DEFAULTS, KEY, SCALUP_AVERAGES

STREAM_COLUMNS = {
    "rga": {"mass": "mass", "current": "current"},
    "scalup": {v: v for v in SCALUP_AVERAGES.values()},
    "status": {c: c for c in ("turbo_speed_hz", "turbo_power_w", "pump_rpm", "raw_total_pressure_current")},
    "par": {"par_umol_m2_s": "par_umol_m2_s", "par_raw": "par_raw"},
}


def all_readings(streams: dict[str, DataFrame], keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Every stream in one frame (absent columns null), so one pass matches all of them to windows."""
    parts = [
        df.select(*keys, "ts", F.lit(name).alias("stream"), *STREAM_COLUMNS[name]) for name, df in streams.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _mean(streams: dict[str, DataFrame], stream: str, column: str) -> Column:
    return exact_avg(column, units=READINGS) if stream in streams else F.lit(None).cast("double")


def stream_means(
    streams: dict[str, DataFrame],
    windows: DataFrame,
    masses: Sequence[int],
    total_pressure_sensitivity: float | str | Column,
    partial_pressure_sensitivity: float | str | Column,
    keys: Sequence[str] = (KEY,),
    strategy: str = "auto",
) -> DataFrame:
    """One conditional aggregate per window over the matched readings of all streams; means do not depend on the order of readings."""
    grain = windows.select(*keys, "window_start", "window_end")
    matched = match_to_windows(all_readings(streams, keys), grain, keys, strategy=strategy)
    means = [_mean(streams, "scalup", src).alias(out) for out, src in SCALUP_AVERAGES.items()]
    means += [_mean(streams, "par", c).alias(c) for c in ("par_umol_m2_s", "par_raw")]
    means += [_mean(streams, "status", c).alias(c) for c in ("turbo_speed_hz", "turbo_power_w")]
    means += [_mean(streams, "status", "pump_rpm").alias("water_pump_rpm"),
              _mean(streams, "status", "raw_total_pressure_current").alias("__tp")]
    if "rga" in streams:
        means += [exact_avg_where(F.col("mass") == m, "current").alias(f"mass_{m}_avg") for m in masses]
        matched = matched.withColumns(cut_columns("current"))
    agg = matched.groupBy(*keys, "window_start").agg(*means)
    return _with_units(agg, streams, masses, total_pressure_sensitivity, partial_pressure_sensitivity)


def _with_units(agg: DataFrame, streams: dict[str, DataFrame], masses: Sequence[int], total_pressure_sensitivity, partial_pressure_sensitivity) -> DataFrame:
    tp, pp = as_col(total_pressure_sensitivity), as_col(partial_pressure_sensitivity)
    derived = {"total_pressure_amps": counts_to_amps(F.col("__tp")), "total_pressure_torr": counts_to_torr(F.col("__tp"), tp)}
    if "rga" in streams:
        for m in masses:
            derived[f"mass_{m}_amps"] = counts_to_amps(F.col(f"mass_{m}_avg"))
            derived[f"mass_{m}_torr"] = counts_to_torr(F.col(f"mass_{m}_avg"), pp)
    return agg.withColumns(derived).drop("__tp")


def _averaged(streams: dict[str, DataFrame], masses: Sequence[int]) -> dict[str, Column | None]:
    """What is averaged on a window, by output name; None where the stream is absent."""
    named = {out: ("scalup", src) for out, src in SCALUP_AVERAGES.items()}
    named |= {c: ("par", c) for c in ("par_umol_m2_s", "par_raw")} | {c: ("status", c) for c in ("turbo_speed_hz", "turbo_power_w")}
    named |= {"water_pump_rpm": ("status", "pump_rpm"), "__tp": ("status", "raw_total_pressure_current")}
    out = {name: F.col(c) if stream in streams else None for name, (stream, c) in named.items()}
    return out | ({f"mass_{m}_avg": F.when(F.col("mass") == m, F.col("current")) for m in masses} if "rga" in streams else {})


def means_over_sets(
    streams: dict[str, DataFrame], windows: DataFrame, masses: Sequence[int], set_key: str, keys: Sequence[str] = (KEY,), strategy: str = "auto"
) -> DataFrame:
    """`stream_means` for the windows of many parameter sets, each reading matched and added up once.

    The windows of all sets cut the time axis into elementary intervals. Readings meet those; what is kept of an interval are
    sums that add up exactly, so a set's means are the ones its own windows would give.
    """
    keys = list(keys)
    cuts, members = elementary_intervals(windows, keys, set_key)
    values = _averaged(streams, masses)
    present = {n: c for n, c in values.items() if c is not None}
    matched = match_to_windows(all_readings(streams, keys), cuts, keys, strategy=strategy)
    sums = matched.groupBy(*keys, F.col("window_start").alias("cut_start")).agg(*[c for n, v in present.items() for c in partial_sums(n, v)])
    per_set = members.join(sums, [*keys, "cut_start"]).groupBy(*keys, set_key, "window_start").agg(*[c for n in present for c in merged_sums(n)])
    means = per_set.select(*keys, set_key, "window_start", *[
        (mean_of_sums(n) if n in present else F.lit(None).cast("double")).alias(n) for n in values])
    return _with_units(means, streams, masses, 1.0, 1.0)


def aggregate_onto_windows(
    windows: DataFrame,
    streams: dict[str, DataFrame],
    masses: Sequence[int],
    total_pressure_sensitivity: float | str | Column = DEFAULTS["total_pressure_sensitivity_a_per_torr"],
    partial_pressure_sensitivity: float | str | Column = DEFAULTS["partial_pressure_sensitivity_a_per_torr"],
    keys: Sequence[str] = (KEY,),
    strategy: str = "auto",
    means: DataFrame | None = None,
) -> DataFrame:
    """Windows with their context and the averages of every stream (or the given ones); windows without readings keep nulls."""
    agg = means if means is not None else stream_means(
        streams, windows, masses, total_pressure_sensitivity, partial_pressure_sensitivity, keys, strategy
    )
    mass_columns = [f"mass_{m}_{s}" for m in sorted(masses) for s in ("avg", "amps", "torr")] if "rga" in streams else []
    return (
        windows.join(agg, [*keys, "window_start"], "left")
        .withColumnRenamed("window_start", "timestamp")
        .select(
            *keys, "timestamp", "experiment_number", "elapsed_us",
            (F.col("elapsed_us") / F.lit(1e6)).alias("elapsed_s"), "chamber", *mass_columns,
            "total_pressure_amps", "total_pressure_torr", *SCALUP_AVERAGES, "par_umol_m2_s", "par_raw",
            "turbo_speed_hz", "turbo_power_w", "water_pump_rpm",
        )
    )


def mass_means(rga: DataFrame, windows: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Canonical long form: mean current per window and mass."""
    grain = windows.select(*keys, "window_start", "window_end")
    return match_to_windows(rga.select(*keys, "ts", "mass", "current"), grain, keys).groupBy(
        *keys, "window_start", "mass"
    ).agg(exact_avg("current", units=READINGS).alias("current"))


def discover_masses(rga: DataFrame) -> list[int]:
    """Distinct masses of a stream, ascending (an instrument scans at most a few hundred)."""
    return sorted(r[0] for r in rga.select("mass").distinct().collect())


def experiment_context(
    readings: DataFrame, valve_windows: DataFrame, settle_s: float, keys: Sequence[str] = (KEY,), ts: str = "ts"
) -> DataFrame:
    """Readings inside a cycle with chamber, experiment, their own elapsed time and a settled-out flag.

    `valve_windows` are cycles without settle time, so their start is the valve switch itself.
    """
    w = valve_windows.select(
        *keys, "window_start", "window_end", "chamber", "experiment_number",
        (micros("window_start") - F.col("elapsed_us")).alias("__exp_start"),
    )
    rows = match_to_windows(readings, w, keys, ts)
    in_cycle = whole_seconds(micros(ts) - micros("window_start"))
    return rows.withColumns(
        {"settled_out": in_cycle < F.lit(settle_s), "elapsed_us": micros(ts) - F.col("__exp_start")}
    ).drop("window_start", "window_end", "__exp_start")
