"""Elementary intervals: the time axis cut at every window of every parameter set, so that readings are matched once for all sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import from_micros, write_and_read
from abyssal.operators.asof import BUCKET_US, effective_windows
from abyssal.ordering import ordered_scan, time_slice

DAY_US = 86_400_000_000


def elementary_intervals(windows: DataFrame, keys: Sequence[str], set_key: str) -> tuple[DataFrame, DataFrame]:
    """(intervals, members) of windows that carry `set_key`.

    Intervals (keys, window_start, window_end) are disjoint and cover what any window covers. Members say which intervals make up
    a window: keys, `set_key`, window_start, cut_start. Within a set the windows count as an as-of match takes them
    (`effective_windows`). Both sides have windows, not readings, and meet by time bucket.
    """
    keys = list(keys)
    own = write_and_read(effective_windows(windows.select(*keys, set_key, "window_start", "window_end"), [*keys, set_key]).select(*keys, set_key, "window_start", "__s", "__e"))
    ends = own.select(*keys, F.explode(F.array(F.struct(F.col("__s").alias("p"), F.lit(1).alias("d")), F.struct(F.col("__e").alias("p"), F.lit(-1).alias("d")))).alias("c"))
    points = ends.groupBy(*keys, F.col("c.p").alias("__p")).agg(F.sum("c.d").alias("__d")).withColumn("__slice", time_slice(F.col("__p"), DAY_US))
    points = ordered_scan(points, keys, ["__slice"], ["__p"], following={"__next": F.col("__p")}, total={"__open": F.col("__d")})
    cuts = write_and_read(points.where("__open > 0 AND __next IS NOT NULL").select(*keys, "__p", "__next"))
    buckets = F.sequence(time_slice(F.col("__s"), BUCKET_US), time_slice(F.col("__e") - 1, BUCKET_US))
    spread = own.withColumn("__b", F.explode(buckets))
    met = spread.join(cuts.withColumn("__b", time_slice(F.col("__p"), BUCKET_US)), [*keys, "__b"]).where("__p >= __s AND __p < __e")
    members = met.select(*keys, set_key, "window_start", from_micros(F.col("__p")).alias("cut_start"))
    return cuts.select(*keys, from_micros(F.col("__p")).alias("window_start"), from_micros(F.col("__next")).alias("window_end")), members
