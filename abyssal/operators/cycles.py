"""Measurement cycles, experiment numbering and scan windows from arrival-ordered streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import add_seconds, as_col, from_micros, micros, write_and_read
from abyssal.operators.asof import attach_window
from abyssal.operators.greedy import RepeatRule, greedy_segments
from abyssal.ordering import ordered_scan
from abyssal.schemas import KEY

CONTEXT = ["chamber", "experiment_number", "elapsed_us"]


def dedupe_consecutive(valve: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Drop rows repeating the previous row's chamber and flush state, in arrival order (never by time)."""
    state = F.struct("chamber", "flush_state")
    carried = ordered_scan(
        valve, keys, ["chunk"], ["pos"],
        prev={"__state": state, "__re_before": F.when(F.col("flush_state") == "Re", F.lit(True))},
    )
    return carried.where(F.col("__state").isNull() | (F.col("__state") != state)).drop("__state")


def label_experiments(valve: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Deduplicated transitions with experiment number, its start and the next transition's time.

    The first Re starts experiment 1. A (C1, Re) starts the next one when the last marker since then, among
    (C2, Fl) and (C1, Re), was (C2, Fl).
    """
    # Written once: the two passes below would otherwise repeat the scan of the valve stream.
    rows = write_and_read(dedupe_consecutive(valve, keys))
    chamber, flush = F.col("chamber"), F.col("flush_state")
    c1_re, c2_fl = (chamber == "C1") & (flush == "Re"), (chamber == "C2") & (flush == "Fl")
    marker = F.when(c1_re, F.lit("open")).when(c2_fl & F.col("__re_before"), F.lit("flushed"))
    rows = ordered_scan(
        rows, keys, ["chunk"], ["pos"], prev={"__marker": marker}, following={"next_ts": F.col("ts")}
    )
    first = (flush == "Re") & F.col("__re_before").isNull()
    starts = first | (c1_re & F.coalesce(F.col("__marker") == "flushed", F.lit(False)))
    rows = rows.withColumn("__starts", starts)
    rows = ordered_scan(
        rows, keys, ["chunk"], ["pos"],
        prev={"__start": F.when(F.col("__starts"), F.col("ts"))},
        total={"__number": F.col("__starts").cast("bigint")},
    )
    return rows.withColumns(
        {
            "experiment_number": F.when(F.col("__number") > 0, F.col("__number")),
            "exp_start": F.when(F.col("__starts"), F.col("ts")).otherwise(F.col("__start")),
        }
    ).drop("__re_before", "__marker", "__starts", "__start", "__number")


def cycle_candidates(valve: DataFrame, settle_s: float | str | Column, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Closed Re cycles with `long_enough`; an open last cycle is no candidate."""
    rows = label_experiments(valve, keys).where(
        "flush_state = 'Re' AND experiment_number IS NOT NULL AND next_ts IS NOT NULL"
    )
    return rows.select(
        *keys,
        add_seconds(F.col("ts"), as_col(settle_s)).alias("window_start"),
        F.col("next_ts").alias("window_end"),
        "chamber",
        "experiment_number",
        (micros("ts") - micros("exp_start")).alias("elapsed_us"),
        "chunk",
        "pos",
    ).withColumn("long_enough", F.col("window_end") > F.col("window_start"))


def cycle_windows(valve: DataFrame, settle_s: float | str | Column, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Measurement windows ``[transition + settle, next transition)``; shorter ones and clock jumps drop out."""
    return long_enough(cycle_candidates(valve, settle_s, keys))


def long_enough(candidates: DataFrame) -> DataFrame:
    """The windows among `cycle_candidates`."""
    return candidates.where("long_enough").drop("long_enough", "chunk", "pos")


def cycle_statistics(valve: DataFrame, settle_s: float | str | Column, keys: Sequence[str] = (KEY,)) -> DataFrame:
    return candidate_statistics(cycle_candidates(valve, settle_s, keys), keys)


def candidate_statistics(candidates: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """All `cycle_candidates` and those too short, per key."""
    return candidates.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_cycles"), F.count_if(~F.col("long_enough")).alias("dropped_too_short")
    )


def experiment_spans(windows: DataFrame, settle_s: float | str | Column, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Sealed incubations ``[first Re, end of the last surviving cycle)``, whatever the settle time."""
    settle_us = F.round(as_col(settle_s) * 1e6).cast("bigint")
    start = micros("window_start") - settle_us - F.col("elapsed_us")
    return windows.groupBy(*keys, "experiment_number").agg(
        from_micros(F.min(start)).alias("experiment_start"), F.max("window_end").alias("experiment_end")
    )


def experiment_starts(rows: DataFrame, ts: str, keys: Sequence[str] = (KEY,), settle_s: float = 0.0) -> DataFrame:
    """Start of each experiment: earliest time minus elapsed time (and minus a settle time already in it)."""
    start = micros(ts) - F.col("elapsed_us") - F.lit(int(round(settle_s * 1e6)))
    return rows.groupBy(*keys, "experiment_number").agg(from_micros(F.min(start)).alias("experiment_start"))


def active_chamber_spans(valve: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Spans over which each chamber is the one being sampled: cycles without settle time."""
    return cycle_windows(valve, 0.0, keys).select(
        *keys, F.col("window_start").alias("start"), F.col("window_end").alias("end"), "chamber"
    )


def scan_ids(
    rga: DataFrame, keys: Sequence[str] = (KEY,), chunk: str = "chunk", pos: Sequence[str] = ("pos",), within: Sequence[str] = ()
) -> DataFrame:
    """Number the scans (``segment``): a new one starts when a mass repeats within the current scan.

    A change of a `within` column (an acquisition run) starts a new scan too.
    """
    return greedy_segments(rga, keys, chunk, pos, [*within, "mass"], RepeatRule())


def scan_windows(rga: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """One window per scan up to the next scan's first time; the open last scan has none."""
    scans = scan_ids(rga.select(*keys, "chunk", "pos", "ts", "mass"), keys).groupBy(*keys, "segment").agg(
        F.min("ts").alias("window_start")
    )
    scans = scans.withColumn("__c", F.floor(F.col("segment") / 100_000).cast("bigint"))
    ordered = ordered_scan(scans, keys, ["__c"], ["segment"], following={"window_end": F.col("window_start")})
    return ordered.where("window_end IS NOT NULL").select(*keys, "segment", "window_start", "window_end")


def attach_chamber_context(scans: DataFrame, cycles: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Chamber, experiment and elapsed time of the cycle a scan starts in; nulls outside every cycle."""
    cyc = cycles.withColumnRenamed("window_start", "__cycle_start").select(*keys, "__cycle_start", "window_end", *CONTEXT)
    cyc = cyc.withColumnRenamed("__cycle_start", "window_start")
    return attach_window(scans.withColumnRenamed("window_end", "scan_end"), cyc, keys, "window_start", CONTEXT).withColumnRenamed(
        "scan_end", "window_end"
    )
