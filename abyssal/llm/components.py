"""Connected components by alternating large-star and small-star over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import remove_dirs, write_and_read


PER_FILE = 50_000  # edges


def _star(edges: DataFrame, made: list[str], large: bool, files: int) -> DataFrame:
    """One star operation on edges (u, v) with u > v; every node's neighbours are hung on its smallest neighbour.

    Large-star hangs only the larger neighbours (and reads each edge from both ends); small-star hangs the smaller ones and the
    node itself. The minima are written first, so that the join shuffles both sides and a star's hub can be split.
    """
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = write_and_read(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).coalesce(files), made)
    joined = both.join(least, "u")
    if large:
        hung = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = joined.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return hung.filter(F.col("u") != F.col("v")).distinct().coalesce(files)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node on an edge (u, v) of longs; the component is its smallest node.

    Each operation is an aggregation with map-side combining and one join on the node. Results go to a table in the shared
    folder, so plans stay short and a lost executor costs one operation. It ends when an operation pair changes nothing, which
    a count and a hash sum over the edges show.
    """
    spark = edges.sparkSession
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter(F.col("u") != F.col("v")).distinct()
    old: list[str] = []
    e = write_and_read(e, old)
    before = _mark(e)
    while True:
        made: list[str] = []
        files = 1 + before[0] // PER_FILE  # a small graph is not spread over many small files
        wide = write_and_read(_star(e, made, True, files), made)
        new: list[str] = []
        e = write_and_read(_star(wide, made, False, files), new)
        after = _mark(e)
        remove_dirs(spark, made + old)
        old = new
        if after == before:
            break
        before = after
    # every edge now joins a node to the smallest node of its component
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h)).first())
