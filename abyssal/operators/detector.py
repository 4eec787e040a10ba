"""Electron multiplier against Faraday cup: acquisition runs, scans, statistics, gain and pressures."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import micros, safe_div, write_and_read
from abyssal.functions.scalars import counts_to_amps
from abyssal.operators.cycles import scan_ids
from abyssal.operators.ratios import scan_ratio
from abyssal.operators.stats import exact_median
from abyssal.ordering import ordered_scan, slice_width, time_slice
from abyssal.schemas import ARGON, DEFAULTS, KEY
from abyssal.sources.logs import parse_payload

CONTROL = r"^OK,(EMON|EMOFF|AON|AOFF)$"
OPEN_END = "9999-12-31 23:59:59.999999"


def read_control(payload_lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(readings, events, status) of a surface log on its receipt time, second resolution with Z only."""
    strict = F.col("receipt").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$")
    rows = payload_lines.withColumn(
        "receipt_ts", F.when(strict, F.regexp_replace("receipt", "Z$", "").try_cast("timestamp_ntz"))
    ).where("receipt_ts IS NOT NULL")
    events = rows.where(F.col("payload").rlike(CONTROL)).select(
        KEY, "receipt_ts", F.regexp_extract("payload", CONTROL, 1).alias("event"), "chunk", "pos"
    )
    parsed = parse_payload(rows)
    readings = parsed.where("tag = 'R'").select(KEY, "receipt_ts", "ts", "mass", F.col("current").alias("counts"), "chunk", "pos")
    status = parsed.where("tag = '!' AND raw_total_pressure_current IS NOT NULL").select(
        KEY, "receipt_ts", "ts", "raw_total_pressure_current", "chunk", "pos"
    )
    return readings, events, status


def spans(events: DataFrame, on: str, off: str) -> DataFrame:
    """On/off events paired in arrival order: repeats of `on` and stray `off` are ignored, an open span never ends."""
    rows = events.where(F.col("event").isin(on, off))
    rows = ordered_scan(rows, [KEY], ["chunk"], ["pos"], prev={"__before": F.col("event")})
    rows = rows.where("__before IS NULL OR __before != event")
    rows = ordered_scan(rows, [KEY], ["chunk"], ["pos"], following={"__end": F.col("receipt_ts")},
                        total={"__n": (F.col("event") == on).cast("bigint")})
    end = F.coalesce("__end", F.lit(OPEN_END).cast("timestamp_ntz"))
    return rows.where(F.col("event") == on).select(KEY, F.col("receipt_ts").alias("start"), end.alias("end"), (F.col("__n") - 1).alias("span"))


def _with_spans(rows: DataFrame, events: DataFrame) -> DataFrame:
    """Add `run`, `run_start` (null outside every run) and `multiplier`, in one ordered pass over all three.

    Runs are closed `[start, end]`, the earlier one first where two touch; multiplier spans are `[start, end)`.
    Receipt times come from one running clock, so spans of a kind follow each other.
    """
    def marks(kind: str, side: int, sp: DataFrame) -> DataFrame:
        inner = F.struct("start", "end", "span")
        return sp.select(KEY, F.col("start").alias("receipt_ts"), F.lit(side).alias("__side"), inner.alias(kind))

    # At one instant: multiplier starts, then readings, then run starts; a run found looking back is earlier.
    both = rows.withColumn("__side", F.lit(1))
    both = both.unionByName(marks("__em", 0, spans(events, "EMON", "EMOFF")), allowMissingColumns=True)
    both = both.unionByName(marks("__run", 2, spans(events, "AON", "AOFF")), allowMissingColumns=True)
    both = both.withColumn("__t", micros("receipt_ts"))
    both = both.withColumn("__slice", time_slice(F.col("__t"), slice_width(rows, [KEY], "receipt_ts")))
    out = ordered_scan(both, [KEY], ["__slice"], ["__t", "__side"], prev={"__em_b": F.col("__em"), "__run_b": F.col("__run")},
                       following={"__run_f": F.col("__run")}).where("__side = 1")
    ts = F.col("receipt_ts")
    run = F.when(ts <= F.col("__run_b.end"), F.col("__run_b")).when(ts == F.col("__run_f.start"), F.col("__run_f"))
    out = out.withColumn("__hit", run)
    return out.select(
        *rows.columns, F.col("__hit.span").alias("run"), F.col("__hit.start").alias("run_start"),
        F.coalesce(ts < F.col("__em_b.end"), F.lit(False)).alias("multiplier"),
    )


def label_readings(
    readings: DataFrame, events: DataFrame, stable_skip_s: float, windows: dict[str, tuple[str, str]] | None = None
) -> DataFrame:
    """Readings inside an acquisition run with detector, run, scan within the run, elapsed time and `stable`.

    `windows` (inclusive times per detector) replace the skip time for that detector.
    """
    rows = write_and_read(_with_spans(readings, events).where("run IS NOT NULL"))
    rows = rows.withColumn("detector", F.when(F.col("multiplier"), "CDEM").otherwise("FC")).drop("multiplier")
    rows = write_and_read(scan_ids(rows, [KEY], within=["run"]).drop("is_start"))
    first = rows.groupBy(KEY, "run").agg(F.min("segment").alias("__first"))
    rows = rows.join(first, [KEY, "run"]).withColumn("scan", F.col("segment") - F.col("__first")).drop("segment", "__first")
    elapsed_us = micros("receipt_ts") - micros("run_start")
    elapsed = ((elapsed_us - elapsed_us % 1000) / 1000).cast("bigint") / 1000
    rows = rows.withColumns({"amps": counts_to_amps(F.col("counts")), "elapsed_s": elapsed})
    stable: Column = F.col("elapsed_s") >= stable_skip_s
    for det, (start, end) in (windows or {}).items():
        inside = F.col("receipt_ts").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
        stable = F.when(F.col("detector") == det, inside).otherwise(stable)
    return rows.withColumn("stable", stable)


def _stable_differences(labelled: DataFrame) -> DataFrame:
    rows = labelled.where("stable").withColumn("ts", F.col("receipt_ts"))
    by = [KEY, "detector", "mass"]
    width = slice_width(rows, by)
    rows = rows.withColumn("__t", micros("ts")).withColumn("__slice", time_slice(F.col("__t"), width))
    rows = ordered_scan(rows, by, ["__slice"], ["__t", "chunk", "pos"], prev={"__before": F.col("amps")})
    return rows.where("__before IS NOT NULL").select(*by, (F.col("amps") - F.col("__before")).alias("d"))


def detector_stats(labelled: DataFrame, reference: int = ARGON) -> DataFrame:
    """Per detector and mass: level, spread, two noise estimates, drift and ratio spread, in Amps and percent.

    Noise comes from successive stable differences, once as their std, once from their median absolute
    deviation, which transients do not move.
    """
    by = [KEY, "detector", "mass"]
    rows = scan_ratio(labelled, reference, [KEY, "run", "scan"], "amps")
    s, ok = F.when(F.col("stable"), F.col("amps")), F.col("stable")
    minutes, ratio = F.when(ok, F.col("elapsed_s") / 60), F.when(ok, F.col("ratio"))
    level = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_stable"),
        F.avg("amps").alias("mean_amps"), F.stddev_samp("amps").alias("sd_amps"),
        F.avg(s).alias("mean_stable_amps"), F.stddev_samp(s).alias("sd_stable_amps"),
        F.when(F.count_if(ok) >= 3, F.regr_slope(s, minutes)).alias("__slope"),
        safe_div(F.stddev_samp(ratio) * 100, F.avg(ratio)).alias(f"ratio_to_m{reference}_rsd_pct"),
    )
    d = write_and_read(_stable_differences(labelled))
    spread = d.groupBy(*by).agg(F.stddev_samp("d").alias("__sd"), F.count(F.lit(1)).alias("__nd"))
    centre = exact_median(d, by, F.col("d"), "__median")
    mad = exact_median(d.join(centre, by), by, F.abs(F.col("d") - F.col("__median")), "__mad")
    out = level.join(spread.join(mad, by), by, "left")
    mean, enough = F.col("mean_stable_amps"), F.col("__nd") >= 2
    pct = lambda c: safe_div(c * 100, mean)
    return out.select(
        *by, "n", "n_stable", "mean_amps", "sd_amps", safe_div(F.col("sd_amps") * 100, F.col("mean_amps")).alias("rsd_pct"),
        "mean_stable_amps", "sd_stable_amps",
        safe_div(F.col("sd_stable_amps"), F.sqrt("n_stable")).alias("se_stable_amps"),
        pct(F.col("sd_stable_amps")).alias("rsd_stable_pct"),
        F.when(enough, pct(F.col("__sd") / math.sqrt(2))).alias("noise_rsd_pct"),
        F.when(enough, pct(1.4826 * F.col("__mad") / math.sqrt(2))).alias("noise_mad_rsd_pct"),
        pct(F.col("__slope")).alias("drift_pct_per_min"),
        f"ratio_to_m{reference}_rsd_pct",
    )


def gain_table(stats: DataFrame, reference: int = ARGON) -> DataFrame:
    """Multiplier over Faraday cup per mass with its propagated error; a mass seen by one detector only stays."""
    columns = ["mean_stable_amps", "se_stable_amps", "noise_rsd_pct", "noise_mad_rsd_pct", f"ratio_to_m{reference}_rsd_pct"]
    side = lambda det, p: stats.where(F.col("detector") == det).select(KEY, "mass", *[F.col(c).alias(f"{p}_{c}") for c in columns])
    g = side("FC", "fc").join(side("CDEM", "cdem"), [KEY, "mass"], "full")
    gain = safe_div(F.col("cdem_mean_stable_amps"), F.col("fc_mean_stable_amps"))
    relative = lambda p: F.pow(safe_div(F.col(f"{p}_se_stable_amps"), F.col(f"{p}_mean_stable_amps")), 2)
    return g.withColumns(
        {
            "cdem_fc_gain": gain,
            "cdem_fc_gain_se": gain * F.sqrt(relative("cdem") + relative("fc")),
            "cdem_sensitivity_a_per_torr_from_nominal_fc": gain * DEFAULTS["partial_pressure_sensitivity_a_per_torr"],
            "noise_improvement_fc_over_cdem": safe_div(F.col("fc_noise_mad_rsd_pct"), F.col("cdem_noise_mad_rsd_pct")),
        }
    )


def add_partial_pressure(labelled: DataFrame, gains: DataFrame, sensitivity: float, gain_mass: int = 28) -> DataFrame:
    """Torr of every reading; the multiplier's readings are divided by the gain measured at one mass."""
    gain = gains.where(F.col("mass") == gain_mass).select(KEY, F.col("cdem_fc_gain").alias("cdem_gain"))
    applied = F.when(F.col("detector") == "CDEM", F.col("cdem_gain")).otherwise(F.lit(1.0))
    return labelled.join(gain, KEY, "left").withColumn("torr", safe_div(F.col("amps"), sensitivity * applied))


def total_pressure(status: DataFrame, events: DataFrame, sensitivity: float = DEFAULTS["total_pressure_sensitivity_a_per_torr"]) -> DataFrame:
    """Total pressure while acquiring with the Faraday cup; it reads zero with the multiplier on."""
    rows = _with_spans(status, events).where("run IS NOT NULL AND NOT multiplier AND raw_total_pressure_current > 0")
    return rows.drop("run", "run_start", "multiplier").withColumn(
        "total_pressure_torr", counts_to_amps(F.col("raw_total_pressure_current")) / sensitivity
    )


def stable_spans(labelled: DataFrame) -> DataFrame:
    return labelled.where("stable").groupBy(KEY, "detector").agg(F.min("receipt_ts").alias("start"), F.max("receipt_ts").alias("end"))


def run_summary(labelled: DataFrame) -> DataFrame:
    # Scans of a run are whole numbers without gaps inside it, so distinct scans are counted on (run, scan) first.
    per_scan = labelled.groupBy(KEY, "run", "detector", "scan").agg(F.min("receipt_ts").alias("a"), F.max("receipt_ts").alias("z"))
    return per_scan.groupBy(KEY, "run", "detector").agg(F.min("a").alias("start"), F.max("z").alias("end"), F.count(F.lit(1)).alias("scans"))


def mean_torr_by_detector(with_torr: DataFrame) -> DataFrame:
    wide = with_torr.where("stable").groupBy(KEY, "mass").pivot("detector", ["FC", "CDEM"]).agg(F.avg("torr"))
    wide = wide.withColumnsRenamed({"FC": "fc_mean_stable_torr", "CDEM": "cdem_mean_stable_torr"})
    return wide.withColumn("cdem_over_fc_torr", safe_div(F.col("cdem_mean_stable_torr"), F.col("fc_mean_stable_torr")))


def pressure_balance(with_torr: DataFrame, tp: DataFrame) -> DataFrame:
    """Mean total pressure against the mean summed partial pressure per scan, over the stable Faraday window."""
    fc = stable_spans(with_torr).where("detector = 'FC'").select(KEY, F.col("start").alias("__a"), F.col("end").alias("__z"))
    total = tp.join(fc, KEY).where("receipt_ts BETWEEN __a AND __z").groupBy(KEY).agg(F.avg("total_pressure_torr").alias("mean_total_torr"))
    summed = with_torr.where("stable AND detector = 'FC'").groupBy(KEY, "scan").agg(F.sum("torr").alias("s")).groupBy(KEY).agg(
        F.avg("s").alias("mean_partial_sum_torr"))
    return fc.select(KEY).join(total, KEY, "left").join(summed, KEY, "left")


