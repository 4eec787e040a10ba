"""Ordered streams that never put one deployment into one task.

Spark's window functions need all rows of a partition key in one task, and one deployment may hold a large
share of an archive. Ordered operators therefore work on chunks: rows carry ``chunk`` (orderable, bounded in
size) and a position inside it. A window runs per (keys, chunk); what has to cross a chunk edge travels
through a table with one row per chunk, which is aggregated map-side and is the only thing ordered per key.

Arrival order uses file splits as chunks; time order uses slices of the time axis whose width follows from
the densest minute of the data (``slice_width``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abyssal.functions.common import micros, write_and_read

ROWS_PER_SLICE = 500_000
MINUTE_US = 60_000_000
DAY_US = 86_400_000_000
LONGEST_SLICE_US = 30 * DAY_US


def slice_width(df: DataFrame, keys: Sequence[str], ts: str = "ts", rows: int = ROWS_PER_SLICE) -> int:
    """Slice width in microseconds at which even the densest minute of any key, repeated, keeps to `rows` per slice.

    One map-side-combined count; a single number reaches the driver. Between one second and thirty days.
    """
    return _width(df.groupBy(*keys, F.floor(micros(ts) / MINUTE_US).alias("minute")).count(), rows)


def _width(minutes: DataFrame, rows: int) -> int:
    per_minute = minutes.agg(F.max("count")).first()[0]
    if not per_minute:
        return LONGEST_SLICE_US
    return int(min(max(MINUTE_US * rows // per_minute, 1_000_000), LONGEST_SLICE_US))


def minute_counts(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Rows per key and minute, written: one pass over the rows tells how wide slices can be and which there are (`sliced_chunks`)."""
    return write_and_read(df.groupBy(*keys, F.floor(micros(ts) / MINUTE_US).alias("minute")).count())


def whole_minutes_width(minutes: DataFrame, rows: int = ROWS_PER_SLICE) -> int:
    """`slice_width` of counted rows, in whole minutes where it is longer than one."""
    width = _width(minutes, rows)
    return width if width < MINUTE_US else width // MINUTE_US * MINUTE_US


def sliced_chunks(minutes: DataFrame, keys: Sequence[str], chunk: str, width_us: int) -> DataFrame:
    """The slices that hold any of the counted rows; `width_us` must be whole minutes."""
    return minutes.select(*keys, time_slice(F.col("minute") * MINUTE_US, width_us).alias(chunk)).distinct()


def time_slice(us: Column, width_us: int) -> Column:
    return F.floor(us / F.lit(width_us)).cast("bigint")


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    chunk: Sequence[str],
    pos: Sequence[str],
    prev: dict[str, Column] | None = None,
    following: dict[str, Column] | None = None,
    total: dict[str, Column] | None = None,
    following_pos: Sequence[str] | None = None,
    rare: Column | None = None,
    chunks: DataFrame | None = None,
) -> DataFrame:
    """Add carried columns to every row of an ordered stream.

    ``prev``: last non-null value strictly before the row; ``following``: first non-null value strictly after
    it; ``total``: running sum up to and including it. Order is ``chunk`` then ``pos`` (``following_pos`` when
    ties sort differently looking ahead). Wrap a value in ``F.struct`` to carry its nulls too.

    ``rare`` holds for the few rows that have any value to carry; only these are then aggregated per chunk. ``chunks`` are the
    keys and chunks of all other rows, if they are known already (more of them do no harm).
    """
    prev, following, total = prev or {}, following or {}, total or {}
    following_pos = list(following_pos or pos)
    part = [*keys, *chunk]
    staged = df.withColumns(
        {f"__p_{n}": c for n, c in prev.items()}
        | {f"__f_{n}": c for n, c in following.items()}
        | {f"__t_{n}": F.coalesce(c, F.lit(0)) for n, c in total.items()}
    )

    before = Window.partitionBy(*part).orderBy(*pos).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*part).orderBy(*pos).rowsBetween(Window.unboundedPreceding, 0)
    # Looking ahead is looking back in descending order: Spark's unbounded-following frame is quadratic.
    after = (
        Window.partitionBy(*part)
        .orderBy(*[F.desc(c) for c in following_pos])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = staged.withColumns(
        {f"__lp_{n}": F.last(f"__p_{n}", ignorenulls=True).over(before) for n in prev}
        | {f"__lt_{n}": F.sum(f"__t_{n}").over(upto) for n in total}
        | {f"__lf_{n}": F.last(f"__f_{n}", ignorenulls=True).over(after) for n in following}
    )

    at, at_following = F.struct(*pos), F.struct(*following_pos)
    per_chunk = (staged if rare is None else staged.where(rare)).groupBy(*part).agg(
        *[F.max_by(f"__p_{n}", F.when(F.col(f"__p_{n}").isNotNull(), at)).alias(f"__cp_{n}") for n in prev],
        *[
            F.min_by(f"__f_{n}", F.when(F.col(f"__f_{n}").isNotNull(), at_following)).alias(f"__cf_{n}")
            for n in following
        ],
        *[F.sum(f"__t_{n}").alias(f"__ct_{n}") for n in total],
    )
    if rare is not None:
        per_chunk = per_chunk.unionByName((chunks if chunks is not None else staged.select(*part).distinct()), allowMissingColumns=True)
        found = [c for c in per_chunk.columns if c not in part]
        per_chunk = per_chunk.groupBy(*part).agg(*[F.first(c, ignorenulls=True).alias(c) for c in found])
    earlier = Window.partitionBy(*keys).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    later = (
        Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in chunk]).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = per_chunk.select(
        *part,
        *[F.last(f"__cp_{n}", ignorenulls=True).over(earlier).alias(f"__ip_{n}") for n in prev],
        *[F.last(f"__cf_{n}", ignorenulls=True).over(later).alias(f"__if_{n}") for n in following],
        *[F.sum(f"__ct_{n}").over(earlier).alias(f"__it_{n}") for n in total],
    )
    return local.join(carried, on=part, how="left").select(
        *df.columns,
        *[F.coalesce(f"__lp_{n}", f"__ip_{n}").alias(n) for n in prev],
        *[F.coalesce(f"__lf_{n}", f"__if_{n}").alias(n) for n in following],
        *[(F.col(f"__lt_{n}") + F.coalesce(f"__it_{n}", F.lit(0))).alias(n) for n in total],
    )
