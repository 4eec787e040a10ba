"""Pump-setpoint analysis: changes from commands and acknowledgements, noise and RSD per setpoint."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abyssal.functions.common import as_col, micros, safe_div, seconds_between, write_and_read
from abyssal.functions.scalars import counts_to_amps
from abyssal.functions.text import iso_timestamp, number
from abyssal.operators.asof import asof_join, asof_lookup
from abyssal.operators.cycles import scan_ids
from abyssal.operators.greedy import HoldRule, greedy_segments
from abyssal.operators.ratios import scan_ratio
from abyssal.ordering import ROWS_PER_SLICE, ordered_scan, slice_width, time_slice
from abyssal.schemas import ARGON, DEFAULTS, KEY

# Patterns of the control lines and keys of the telemetry line.
COMMAND, ACK, ACQ_ON = r"\bSPD(\d{3,4})\b", r"\bOK,SPD(\d{3,4})?\b", r"\bOK,AON\b"
LEADING_TIME = r"^(\d{4}-\d{2}-\d{2}T[\d:.]+Z?)"
TELEMETRY = {"SPD": "speed_hz", "PWR": "power_w", "ETEMP": "etemp_c", "BTEMP": "btemp_c", "MTEMP": "mtemp_c", "TP": "tp_raw"}
SEGMENT = ["segment", "leg", "setpoint", "change_ts"]


def timestamped_lines(lines: DataFrame) -> DataFrame:
    """Lines with the only time they have: the receipt time, or a time the lander's own line starts with.

    Events lines are `time direction payload`; lander surface lines `time payload`.
    """
    line, name = F.col("line"), F.col("file_name")
    events, surface = name.endswith("_events.log"), name.startswith("surface_")
    stamp = F.when(surface, F.regexp_extract(line, r"^(\S+)", 1)).otherwise(F.regexp_extract(line, LEADING_TIME, 1))
    body = (
        F.when(events, F.regexp_extract(line, r"^\S+\s+\S+\s+(.+)$", 1))
        .when(surface, F.regexp_extract(line, r"^\S+\s+(.+)$", 1))
        .otherwise(line)
    )
    return lines.where(~line.startswith("#")).withColumns({"ts": iso_timestamp(stamp), "payload": body}).where(
        "ts IS NOT NULL AND payload != ''"
    )


def extract_control(lines: DataFrame) -> DataFrame:
    """Commands, acknowledgements, acquisition-on and telemetry rows, told apart in that order of tests."""
    p = F.col("payload")
    kind = (
        F.when(p.rlike(ACK), "ack").when(p.rlike(ACQ_ON), "acq_on").when(p.rlike(COMMAND), "command")
        .when(p.startswith("TS,"), "telemetry")
    )
    digits = F.when(p.rlike(ACK), F.regexp_extract(p, ACK, 1)).otherwise(F.regexp_extract(p, COMMAND, 1))
    setpoint = F.when(digits.rlike(r"^\d+$"), digits.try_cast("bigint"))
    pair = lambda k: number(F.regexp_extract(p, rf"[,]{k}=([^,]*)", 1))
    rows = lines.withColumn("kind", kind).where("kind IS NOT NULL")
    is_t = F.col("kind") == "telemetry"
    return rows.withColumn("setpoint", F.when(F.col("kind").isin("ack", "command"), setpoint)).withColumns(
        {c: F.when(is_t, pair(k)) for k, c in TELEMETRY.items()}
    )


def _in_time(df: DataFrame, *ties: str) -> tuple[DataFrame, list[str]]:
    """Time-ordered chunks of a control stream, as wide as its densest minute allows."""
    width = slice_width(df, [KEY])
    out = df.withColumn("__t", micros("ts")).withColumn("__slice", time_slice(F.col("__t"), width))
    return out, ["__t", *ties]


def collapse_repeats(rows: DataFrame, window_s: float, ties: Sequence[str] = ("chunk", "pos")) -> DataFrame:
    """Keep a sighting unless it repeats the last kept setpoint within the window of that kept one."""
    timed, pos = _in_time(rows, *ties)
    kept = greedy_segments(timed, [KEY], "__slice", pos, ["setpoint", "__t"], HoldRule(int(round(window_s * 1e6))))
    return kept.where("is_start").select(*rows.columns)


def build_setpoint_changes(commands: DataFrame, acks: DataFrame, window_s: float) -> DataFrame:
    """One row per setpoint change, at the acknowledgement, or at the command when none answers in time.

    `commands` / `acks`: deployment_id, ts, setpoint, source_file, chunk, pos. An acknowledgement without
    digits takes the last request's setpoint and is ignored without one.
    """
    columns = [KEY, "ts", "setpoint", "source_file", "chunk", "pos"]
    # Control lines are rare; each step is written once so that later ones do not repeat it.
    requests = write_and_read(collapse_repeats(commands.select(*columns), window_s))
    last = requests.select(KEY, "ts", F.col("setpoint").alias("__asked"))
    filled = asof_join(acks.select(*columns), last, [KEY], ["__asked"])
    filled = filled.withColumn("setpoint", F.coalesce("setpoint", "__asked")).where("setpoint IS NOT NULL").select(*columns)
    accepted = write_and_read(collapse_repeats(write_and_read(filled), window_s))
    near = asof_join(
        requests, accepted.select(KEY, "setpoint", "ts", F.lit(True).alias("__seen")), [KEY, "setpoint"], ["__seen"],
        direction="nearest", matched_ts="__ack_ts",
    )
    gap = F.abs(seconds_between(F.col("ts"), F.col("__ack_ts")))
    unanswered = near.where(F.col("__ack_ts").isNull() | (gap > window_s)).select(*columns)
    changes = accepted.withColumn("source", F.lit("ack")).unionByName(unanswered.withColumn("source", F.lit("command")))
    timed, pos = _in_time(changes, "source", "chunk", "pos")
    timed = ordered_scan(timed, [KEY], ["__slice"], pos, prev={"__before": F.col("setpoint")})
    kept = timed.where("__before IS NULL OR __before != setpoint")
    return add_segments(write_and_read(kept.select(KEY, "ts", "setpoint", "source", "source_file")))


def add_segments(changes: DataFrame) -> DataFrame:
    """Running number of every hold, and `leg`: "up" or "down" by comparison with the hold before.

    Where there is none before, the hold after it decides; with neither, "down".
    """
    timed, pos = _in_time(changes.drop("segment", "leg"), "source", "setpoint")
    timed = ordered_scan(timed, [KEY], ["__slice"], pos, prev={"__before": F.col("setpoint")}, total={"__n": F.lit(1)})
    step = F.col("setpoint") - F.col("__before")
    timed = timed.withColumn("__leg", F.when(step < 0, "down").when(step > 0, "up"))
    timed = ordered_scan(timed, [KEY], ["__slice"], pos, following={"__next_leg": F.col("__leg")})
    return timed.withColumns(
        {"segment": F.col("__n") - 1, "leg": F.coalesce("__leg", "__next_leg", F.lit("down"))}
    ).drop("__t", "__slice", "__before", "__n", "__leg", "__next_leg")


def add_acquisition_on(changes: DataFrame, acq_on: DataFrame) -> DataFrame:
    """First acquisition-on at or after each change and before the next change; null otherwise."""
    changes = write_and_read(changes)
    on = acq_on.select(KEY, F.col("ts").alias("__on")).distinct()
    rows = asof_join(changes, on, [KEY], [], right_ts="__on", direction="forward", matched_ts="acq_on_ts")
    timed, pos = _in_time(rows, "segment")
    timed = ordered_scan(timed, [KEY], ["__slice"], pos, following={"__next": F.col("ts")})
    valid = F.col("__next").isNull() | (F.col("acq_on_ts") < F.col("__next"))
    return timed.withColumn("acq_on_ts", F.when(valid, F.col("acq_on_ts"))).drop("__t", "__slice", "__next")


def tag_readings(readings: DataFrame, changes: DataFrame, settle_s: float) -> DataFrame:
    """Readings with the setpoint in effect and whether they fall in its settle time; earlier ones drop out."""
    right = changes.select(
        KEY, "ts", "acq_on_ts", "setpoint", "segment", "leg", F.col("source").alias("change_source"),
        F.col("segment").alias("__order"),
    )
    rows = asof_lookup(
        readings, right, [KEY], ["acq_on_ts", "setpoint", "segment", "leg", "change_source"],
        right_order="__order", matched_ts="change_ts",
    ).where("setpoint IS NOT NULL")
    since_on = seconds_between(F.coalesce("acq_on_ts", "change_ts"), F.col("ts"))
    return rows.withColumns(
        {"t_since_change_s": seconds_between(F.col("change_ts"), F.col("ts")), "t_since_acq_on_s": since_on,
         "in_settle": since_on < F.lit(settle_s)}
    )


def with_differences(rows: DataFrame, value: str, within: Sequence[str], ties: Sequence[str] = ("chunk", "pos"), number_rows: bool = False) -> DataFrame:
    """Add ``diff`` to the previous reading in time within the given columns, and the 0-based index ``i``.

    Groups no larger than a slice may be are ordered as they are; larger ones in slices of the time axis.
    """
    timed, pos = rows.withColumn("__t", micros("ts")), ["__t", *ties]
    largest = rows.groupBy(*within).count().agg(F.max("count")).first()[0] or 0
    if largest <= ROWS_PER_SLICE:
        group = Window.partitionBy(*within).orderBy(*pos)
        before = F.last(value, ignorenulls=True).over(group.rowsBetween(Window.unboundedPreceding, -1))
        out = timed.withColumns({"__before": before, "__slice": F.lit(0)} | ({"__n": F.row_number().over(group).cast("bigint")} if number_rows else {}))
    else:
        timed = timed.withColumn("__slice", time_slice(F.col("__t"), slice_width(rows, within)))
        total = {"__n": F.lit(1)} if number_rows else None
        out = ordered_scan(timed, within, ["__slice"], pos, prev={"__before": F.col(value)}, total=total)
    out = out.withColumn("diff", F.col(value) - F.col("__before"))
    if number_rows:
        out = out.withColumn("i", F.col("__n") - 1).drop("__n")
    return out.drop("__t", "__slice", "__before")


def _stats(column: str, prefix: str) -> list[Column]:
    return [F.avg(column).alias(f"{prefix}_mean"), F.stddev_samp(column).alias(f"{prefix}_std")]


def _spread(rows: DataFrame, keys: Sequence[str], value: str, prefix: str, extra: Sequence[Column] = ()) -> DataFrame:
    """Mean, std and noise per key and mass, and RSD both ways (std over the hold; successive differences)."""
    kept = with_differences(rows, value, [KEY, "segment", "mass"])
    agg = kept.groupBy(KEY, *keys, "mass").agg(
        F.count(F.lit(1)).alias("n"), *_stats(value, prefix),
        (F.stddev_samp("diff") / math.sqrt(2)).alias(f"{prefix}_noise"), *extra,
    )
    return agg.withColumns(
        {"rsd_pct": safe_div(100 * F.col(f"{prefix}_std"), F.col(f"{prefix}_mean")),
         "rsd_diff_pct": safe_div(100 * F.col(f"{prefix}_noise"), F.col(f"{prefix}_mean"))}
    )


def mass_stats(tagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    extra = [*_stats("amps", "amps"), *_stats("torr", "torr")]
    return _spread(tagged.where("NOT in_settle"), keys, "current", "current_raw", extra)


def add_ratio(tagged: DataFrame, reference: int = ARGON) -> DataFrame:
    """Scan number (in time order) and the ratio to the reference mass of the same scan.

    `tagged` should be a written table: it is read for the slices, for the summaries, for the numbers and for the rows.
    """
    timed = tagged.withColumn("__t", micros("ts"))
    timed = timed.withColumn("__slice", time_slice(F.col("__t"), slice_width(tagged, [KEY])))
    # Scans are numbered under `segment`, the name of the setpoint hold here, so the hold steps aside meanwhile.
    rows = scan_ids(timed.withColumnRenamed("segment", "__hold"), [KEY], "__slice", ["__t", "chunk", "pos"])
    rows = rows.withColumnsRenamed({"segment": "scan_id", "__hold": "segment"}).drop("is_start", "__t", "__slice")
    return scan_ratio(rows, reference, [KEY, "scan_id"])


def ratio_stats(tagged: DataFrame, keys: Sequence[str], reference: int = ARGON) -> DataFrame:
    kept = tagged.where(~F.col("in_settle") & (F.col("mass") != reference) & F.col("ratio").isNotNull())
    return _spread(kept, keys, "ratio", "ratio")


def build_turbo(telemetry: DataFrame, status: DataFrame) -> DataFrame:
    """Pump readings of the telemetry lines and the status rows; rows with neither speed nor pressure go."""
    columns = [*TELEMETRY.values()]
    ts_rows = telemetry.select(KEY, "ts", F.lit("TS").alias("source"), *columns)
    names = ["turbo_speed_hz", "turbo_power_w", "turbo_etemp_c", "turbo_btemp_c", "turbo_mtemp_c", "raw_total_pressure_current"]
    st = status.select(KEY, "ts", F.lit("status").alias("source"), *[F.col(a).alias(b) for a, b in zip(names, columns)])
    return ts_rows.unionByName(st).where("tp_raw IS NOT NULL OR speed_hz IS NOT NULL")


def pump_stats(tagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    agg = tagged.where("NOT in_settle").groupBy(KEY, *keys).agg(
        F.count("tp_raw").alias("n"),
        *[c for v in ("speed_hz", "power_w", "tp_raw", "tp_amps", "tp_torr") for c in _stats(v, v)],
    )
    return agg.withColumn("tp_rsd_pct", safe_div(100 * F.col("tp_raw_std"), F.col("tp_raw_mean")))


def noise_floor_summary(by_speed: DataFrame, rsd_tests: DataFrame, noise_tests: DataFrame) -> DataFrame:
    """Signal, noise and RSD at the lowest setpoint relative to the highest, with the adjusted p-values."""
    d = by_speed.where("current_raw_noise > 0")
    ends = d.groupBy(KEY).agg(F.min("setpoint").alias("setpoint_lo"), F.max("setpoint").alias("setpoint_hi"))
    both = d.join(ends, KEY).groupBy(KEY, "mass", "setpoint_lo", "setpoint_hi")
    at = lambda c, end: F.max(F.when(F.col("setpoint") == F.col(end), F.col(c)))
    ratio = lambda c: safe_div(at(c, "setpoint_lo"), at(c, "setpoint_hi"))
    rows = both.agg(
        ratio("current_raw_mean").alias("signal_lo_hi"), ratio("current_raw_noise").alias("noise_lo_hi"),
        ratio("rsd_diff_pct").alias("rsd_lo_hi"),
        F.count_if(F.col("setpoint") == F.col("setpoint_lo")).alias("__lo"),
        F.count_if(F.col("setpoint") == F.col("setpoint_hi")).alias("__hi"),
    ).where("__lo > 0 AND __hi > 0").drop("__lo", "__hi")
    pick = lambda t, name: t.select(KEY, "mass", F.col("p_adj").alias(name))
    return rows.join(pick(rsd_tests, "p_adj_rsd"), [KEY, "mass"], "left").join(pick(noise_tests, "p_adj_noise"), [KEY, "mass"], "left")


def prepare_rga(rga: DataFrame, sensitivity: float | str | Column = DEFAULTS["partial_pressure_sensitivity_a_per_torr"]) -> DataFrame:
    amps = counts_to_amps(F.col("current"))
    return rga.withColumns({"amps": amps, "torr": safe_div(amps, as_col(sensitivity))})


def prepare_turbo(turbo: DataFrame, sensitivity: float | str | Column = DEFAULTS["total_pressure_sensitivity_a_per_torr"]) -> DataFrame:
    amps = counts_to_amps(F.col("tp_raw"))
    return turbo.withColumns({"tp_amps": amps, "tp_torr": safe_div(amps, as_col(sensitivity))})


def window(df: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Inclusive time window, open where not given."""
    if start is not None:
        df = df.where(F.col("ts") >= start)
    return df if end is None else df.where(F.col("ts") <= end)


def analyze(
    rga: DataFrame, status: DataFrame, telemetry: DataFrame, changes: DataFrame, settle_s: float,
    start: Column | None = None, end: Column | None = None, reference: int = ARGON, only: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """All tables of the analysis, or `only` those named. Changes are windowed first, so earlier readings have no setpoint.

    Ratios and pump readings are written when one of their tables is asked for.
    """
    from abyssal.operators.spread import setpoint_spread_tests

    wanted = lambda *names: only is None or bool({*names} & {*only})
    changes = add_segments(window(changes, start, end))
    changes = write_and_read(changes)
    tagged = write_and_read(tag_readings(prepare_rga(window(rga, start, end)), changes, settle_s))
    if wanted("rga_tagged", "ratio_stats_by_speed", "ratio_stats_by_segment", "ratio_speed_tests"):
        tagged = write_and_read(add_ratio(tagged, reference))
    makers: dict[str, Callable[[], DataFrame]] = {"speed_changes": lambda: changes, "rga_tagged": lambda: tagged}
    if wanted("turbo_tagged", "tp_by_speed", "tp_by_segment"):
        turbo = write_and_read(tag_readings(prepare_turbo(window(build_turbo(telemetry, status), start, end)), changes, settle_s))
        makers |= {"turbo_tagged": lambda: turbo, "tp_by_speed": lambda: pump_stats(turbo, ["setpoint"]), "tp_by_segment": lambda: pump_stats(turbo, SEGMENT)}
    by_speed = cache(lambda: mass_stats(tagged, ["setpoint"]))
    rsd, noise = (cache(lambda relative=r: setpoint_spread_tests(tagged, relative=relative)) for r in (True, False))
    makers |= {
        "mass_stats_by_speed": by_speed,
        "mass_stats_by_segment": lambda: mass_stats(tagged, SEGMENT),
        "rsd_speed_tests": rsd,
        "noise_speed_tests": noise,
        "noise_floor_summary": lambda: noise_floor_summary(by_speed(), rsd(), noise()),
        "ratio_stats_by_speed": lambda: ratio_stats(tagged, ["setpoint"], reference),
        "ratio_stats_by_segment": lambda: ratio_stats(tagged, SEGMENT, reference),
        "ratio_speed_tests": lambda: setpoint_spread_tests(tagged.where(F.col("mass") != reference), "ratio"),
    }
    return {name: make() for name, make in makers.items() if wanted(name)}
