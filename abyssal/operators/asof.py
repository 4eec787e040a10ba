"""As-of joins (backward, forward, nearest) and reading-to-window matching.

Spark has no public as-of join. Ways with the same result:

* carry: union both sides, order them inside time slices and carry the other side's row along
  (``ordering.ordered_scan``). One shuffle of the readings, no candidate pairs, any size on both sides.
* broadcast: when the window side's size estimate is under Spark's broadcast threshold, readings stay where
  they are and look up the windows by time bucket in a broadcast hash join. Rows of an as-of join's right side are
  windows too, each up to the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import from_micros, micros, write_and_read
from abyssal.ordering import MINUTE_US, minute_counts, ordered_scan, slice_width, sliced_chunks, time_slice, whole_minutes_width

MOST_BUCKETS = 100_000
BUCKET_US = 900_000_000
MOST_CANDIDATES = 64  # right rows that a left row may be compared with in its bucket


def _union_and_carry(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    carry: Sequence[str],
    right_order: str | None,
    width_us: int | None,
    look_back: bool,
    look_ahead: bool,
) -> DataFrame:
    """Left rows plus ``__back`` / ``__ahead``: the right row (struct) in effect before and after each."""
    order = F.col(right_order) if right_order else F.lit(0)
    r = right.where(F.col(right_ts).isNotNull()).select(
        *keys,
        F.lit(0).alias("__side"),
        micros(right_ts).alias("__t"),
        order.cast("bigint").alias("__o"),
        F.struct(micros(right_ts).alias("__rt"), *[F.col(c).alias(f"__c_{c}") for c in carry]).alias("__r"),
    )
    chunks = None
    if width_us is None:
        # as narrow as the denser side asks for
        minutes = minute_counts(left, keys, left_ts)
        width_us = min(whole_minutes_width(minutes), slice_width(right, keys, right_ts))
        if width_us >= MINUTE_US:
            width_us = width_us // MINUTE_US * MINUTE_US
            chunks = sliced_chunks(minutes, keys, "__slice", width_us)
    l = left.withColumns({"__side": F.lit(1), "__t": micros(left_ts), "__o": F.lit(0).cast("bigint")})
    both = l.unionByName(r, allowMissingColumns=True).withColumns(
        {"__slice": time_slice(F.col("__t"), width_us), "__flip": 1 - F.col("__side")}
    )
    out = ordered_scan(
        both,
        keys,
        ["__slice"],
        ["__t", "__side", "__o"],
        prev={"__back": F.col("__r")} if look_back else None,
        following={"__ahead": F.col("__r")} if look_ahead else None,
        following_pos=["__t", "__flip", "__o"],
        rare=F.col("__side") == 0,
        chunks=chunks,
    )
    found = [c for c, on in (("__back", look_back), ("__ahead", look_ahead)) if on]
    return out.where("__side = 1").select(*left.columns, "__t", *found)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    carry: Sequence[str],
    left_ts: str = "ts",
    right_ts: str = "ts",
    direction: str = "backward",
    right_order: str | None = None,
    matched_ts: str | None = None,
    width_us: int | None = None,
) -> DataFrame:
    """Every left row with the `carry` columns of its as-of match (nulls without one).

    backward: latest right row at or before; forward: first at or after; nearest: the closer of both, the
    earlier one on a tie. ``matched_ts`` adds the matched right time. Column names in ``carry`` must not
    occur on the left.
    """
    rows = _union_and_carry(
        left, right, keys, left_ts, right_ts, carry, right_order, width_us,
        direction in ("backward", "nearest"), direction in ("forward", "nearest"),
    )
    if direction == "backward":
        hit = F.col("__back")
    elif direction == "forward":
        hit = F.col("__ahead")
    else:
        to_back = F.col("__t") - F.col("__back.__rt")
        to_ahead = F.col("__ahead.__rt") - F.col("__t")
        hit = F.when(to_ahead.isNull() | (to_back <= to_ahead), F.col("__back")).otherwise(F.col("__ahead"))
    rows = rows.withColumn("__hit", hit)
    extra = [from_micros(F.col("__hit.__rt")).alias(matched_ts)] if matched_ts else []
    return rows.select(*left.columns, *[F.col(f"__hit.__c_{c}").alias(c) for c in carry], *extra)


def _rows_as_windows(right: DataFrame, keys: Sequence[str], carry: Sequence[str], ts: str, order: str | None) -> DataFrame:
    """Right rows (`__r`) from their own time `__s` up to the next one's, `__e`; null after the last."""
    o = F.col(order) if order else F.lit(0)
    row = F.struct(micros(ts).alias("__rt"), *[F.col(c).alias(f"__c_{c}") for c in carry])
    w = right.where(F.col(ts).isNotNull()).select(*keys, micros(ts).alias("__s"), o.cast("bigint").alias("__o"), row.alias("__r"))
    w = w.withColumn("__slice", time_slice(F.col("__s"), slice_width(right, keys, ts)))
    w = ordered_scan(w, keys, ["__slice"], ["__s", "__o"], following={"__e": F.col("__s")})
    return w.where("__e IS NULL OR __e > __s").drop("__slice", "__o")


def asof_lookup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], carry: Sequence[str], left_ts: str = "ts", right_ts: str = "ts",
    right_order: str | None = None, matched_ts: str | None = None,
) -> DataFrame:
    """The backward `asof_join`; a small right side (a written table) is broadcast and left rows stay where they are.

    Buckets are as narrow as the right side's densest minute asks for; when that makes too many, both sides are carried.
    """
    keys = list(keys)
    windows = None
    if small_enough_to_broadcast(right):
        bucket_us = slice_width(right, keys, right_ts, MOST_CANDIDATES)
        windows = write_and_read(_rows_as_windows(right, keys, carry, right_ts, right_order))
        touched = time_slice(F.col("__e") - 1, bucket_us) - time_slice(F.col("__s"), bucket_us) + 1
        if (windows.agg(F.sum(touched)).first()[0] or 0) > MOST_BUCKETS:
            windows = None
    if windows is None:
        return asof_join(left, right, keys, carry, left_ts, right_ts, right_order=right_order, matched_ts=matched_ts)
    buckets = F.explode(F.sequence(time_slice(F.col("__s"), bucket_us), time_slice(F.col("__e") - 1, bucket_us)))
    closed = F.broadcast(windows.where("__e IS NOT NULL").withColumn("__b", buckets)).alias("w")
    last = F.broadcast(windows.where("__e IS NULL")).alias("z")
    t = micros(left_ts)
    rows = left.withColumns({"__t": t, "__b": time_slice(t, bucket_us)}).alias("l")
    same = lambda side: [F.col(f"l.{k}").eqNullSafe(F.col(f"{side}.{k}")) for k in keys]
    in_time = [F.col("l.__b") == F.col("w.__b"), F.col("l.__t") >= F.col("w.__s"), F.col("l.__t") < F.col("w.__e")]
    rows = rows.join(closed, [*same("w"), *in_time], "left").join(last, [*same("z"), F.col("l.__t") >= F.col("z.__s")], "left")
    rows = rows.select(*[F.col(f"l.{c}") for c in left.columns], F.coalesce("w.__r", "z.__r").alias("__hit"))
    extra = [from_micros(F.col("__hit.__rt")).alias(matched_ts)] if matched_ts else []
    return rows.select(*left.columns, *[F.col(f"__hit.__c_{c}").alias(c) for c in carry], *extra)


def small_enough_to_broadcast(df: DataFrame) -> bool:
    """Catalyst's size estimate against spark.sql.autoBroadcastJoinThreshold (exact for written tables)."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= int(threshold)


def with_tie(windows: DataFrame, order: str | None) -> DataFrame:
    """`__tie`: which of windows with equal starts counts, the last in ``order``, or else the one that ends last."""
    return windows.withColumn("__tie", F.col(order).cast("bigint") if order else micros("window_end"))


def effective_windows(windows: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Windows cut at the next window's start, so at most one holds any instant, as an as-of join picks.

    A window that ends before it starts still cuts its predecessor; of equal starts the one with the greatest tie value stays.
    """
    w = with_tie(windows, order).withColumn("__s", micros("window_start"))
    w = w.withColumn("__slice", F.floor(F.col("__s") / F.lit(86_400_000_000)).cast("bigint"))
    w = ordered_scan(w, keys, ["__slice"], ["__s", "__tie"], following={"__next": F.col("__s")})
    end = F.least(micros("window_end"), F.col("__next"))
    return w.withColumn("__e", end).where("__e > __s").drop("__slice", "__next", "__tie")


def _bucket_count(windows: DataFrame, bucket_us: int) -> int:
    """Rows that the windows become when each is copied to every time bucket it touches."""
    touched = F.greatest(F.lit(0), time_slice(micros("window_end"), bucket_us) - time_slice(micros("window_start"), bucket_us)) + 1
    return windows.agg(F.sum(touched)).first()[0] or 0


def _bucketed(windows: DataFrame, keys: Sequence[str], order: str | None, bucket_us: int) -> DataFrame:
    """Effective windows, once for every time bucket they touch."""
    w = effective_windows(windows, keys, order)
    return w.withColumn("__b", F.explode(F.sequence(time_slice(F.col("__s"), bucket_us), time_slice(F.col("__e") - 1, bucket_us))))


def match_to_windows(
    readings: DataFrame,
    windows: DataFrame,
    keys: Sequence[str] = ("deployment_id",),
    ts: str = "ts",
    order: str | None = None,
    strategy: str = "auto",
    bucket_us: int = BUCKET_US,
    width_us: int | None = None,
) -> DataFrame:
    """Readings inside a window ``[window_start, window_end)``, with the window's columns; others dropped.

    The window is the latest one starting at or before the reading; the end is checked afterwards. Of equal starts `with_tie`
    says which, for both strategies. Windows are broadcast when they are small and their time buckets few (`MOST_BUCKETS`).
    """
    keys = list(keys)
    carry = [c for c in windows.columns if c not in keys]
    if strategy == "auto":
        strategy = "broadcast" if small_enough_to_broadcast(windows) and _bucket_count(windows, bucket_us) <= MOST_BUCKETS else "carry"
    if strategy == "carry":
        rows = asof_join(
            readings, with_tie(windows, order), keys, [c for c in carry if c != "window_start"], ts, "window_start",
            right_order="__tie", matched_ts="window_start", width_us=width_us,
        )
        return rows.where(F.col(ts) < F.col("window_end"))
    w = _bucketed(windows, keys, order, bucket_us)
    t = micros(ts)
    hit = readings.withColumns({"__t": t, "__b": time_slice(t, bucket_us)}).join(F.broadcast(w), [*keys, "__b"])
    return hit.where("__t >= __s AND __t < __e").select(*readings.columns, *carry)


def attach_window(
    rows: DataFrame,
    windows: DataFrame,
    keys: Sequence[str],
    ts: str,
    carry: Sequence[str],
    order: str | None = None,
    width_us: int | None = None,
) -> DataFrame:
    """Left form of the match: every row stays, `carry` is null when the row's time is in no window.

    Few windows are broadcast, and rows stay where they are.
    """
    keys = list(keys)
    if small_enough_to_broadcast(windows) and _bucket_count(windows, BUCKET_US) <= MOST_BUCKETS:
        w = _bucketed(windows, keys, order, BUCKET_US).select(*keys, "__b", "__s", "__e", *[F.col(c).alias(f"__c_{c}") for c in carry])
        timed = rows.withColumns({"__t": micros(ts), "__b": time_slice(micros(ts), BUCKET_US)}).alias("l")
        w = F.broadcast(w).alias("r")
        on = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in [*keys, "__b"]] + [F.col("__t") >= F.col("__s"), F.col("__t") < F.col("__e")]
        hit = timed.join(w, on, "left")
        return hit.select(*[F.col(f"l.{c}") for c in rows.columns], *[F.col(f"__c_{c}").alias(c) for c in carry])
    out = asof_join(rows, with_tie(windows, order).withColumnRenamed("window_end", "__end"), keys, [*carry, "__end"], ts,
                    "window_start", right_order="__tie", width_us=width_us)
    inside: Column = F.col(ts) < F.col("__end")
    return out.select(*rows.columns, *[F.when(inside, F.col(c)).alias(c) for c in carry])
