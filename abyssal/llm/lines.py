"""Line deduplication by distinct-site spread: lines that stand on many sites are boilerplate and go.

A line's key is two 64-bit hashes of the line without outer blanks; blank lines have none and always stay. One HyperLogLog sketch
of sites per key is built and merged by aggregation, so a line on a third of all rows leaves one small sketch per task. Keys whose
estimate is near the threshold get an exact distinct count; the others are decided by the estimate, which is then several standard
errors away. A line that is boilerplate goes from every document it stands in.

A null site is a site of its own. Null and empty texts have one blank line. Rows that share an id keep their own lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import remove_dirs, write_and_read

BLANKS = " \t\n\x0b\f\r"
LG_K = 11  # 2048 registers: a standard error of 2.3 % for large spreads, next to none for small ones
MARGIN = 0.12  # of the threshold, on both sides; at least 2 sites


def line_list(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """128 bits of the trimmed line; null for a blank line."""
    trimmed = F.btrim(line, F.lit(BLANKS))
    return F.when(trimmed != "", F.struct(F.xxhash64(trimmed).alias("a"), F.xxhash64(F.lit("line"), trimmed).alias("b")))


def _keyed(docs: DataFrame, text_col: str, *columns: Column) -> DataFrame:
    keys = F.transform(line_list(F.col(text_col)), line_key)
    return docs.select(*columns, F.explode(F.filter(keys, lambda k: k.isNotNull())).alias("k")).select("*", "k.a", "k.b").drop("k")


def boilerplate_keys(docs: DataFrame, min_sites: int, text_col: str = "text", site_col: str = "source") -> DataFrame:
    """Keys (a, b) of the lines that stand on ``min_sites`` sites or more."""
    made: list[str] = []
    name = F.col(site_col).cast("string")
    site = F.when(name.isNull(), "null").otherwise(F.concat(F.lit("="), name)).alias("site")
    rows = _keyed(docs, text_col, site)
    sketches = rows.groupBy("a", "b").agg(F.hll_sketch_agg("site", LG_K).alias("sketch"))
    spread = sketches.select("a", "b", F.hll_sketch_estimate("sketch").alias("sites"))
    margin = max(2, round(MARGIN * min_sites))
    spread = write_and_read(spread.filter(F.col("sites") >= min_sites - margin), made)
    sure = spread.filter(F.col("sites") > min_sites + margin).select("a", "b")
    near = spread.filter(F.col("sites") <= min_sites + margin).select("a", "b")
    counted = rows.join(near, ["a", "b"], "left_semi").groupBy("a", "b").agg(F.count_distinct("site").alias("n"))
    found = write_and_read(sure.union(counted.filter(F.col("n") >= min_sites).select("a", "b")))
    remove_dirs(docs.sparkSession, made)
    return found


def without_boilerplate(docs: DataFrame, min_sites: int = 10, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """Per row of ``docs``: id, n_lines, n_removed, kept (the text without its boilerplate lines)."""
    found = boilerplate_keys(docs, min_sites, text_col, site_col)
    hits = _keyed(docs, text_col, F.col(id_col).alias("_id")).distinct().join(found, ["a", "b"])
    # what goes is decided by the line alone, so rows that share an id may share their list
    lists = write_and_read(hits.groupBy("_id").agg(F.collect_set(F.struct("a", "b")).alias("_gone")))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    joined = rows.join(lists.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("_id")), "left")
    lines = line_list(F.col("text"))
    kept = F.when(F.col("_gone").isNull(), lines).otherwise(F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col("_gone"), line_key(x)), F.lit(False))))
    out = joined.select("id", F.size(lines).cast("bigint").alias("n_lines"), kept.alias("kept"))
    return out.select(F.col("id").alias(id_col), "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_removed"), F.array_join("kept", "\n").alias("kept"))
