"""Whitening of embeddings on the integer grid of 1/256, fitted on each distinct vector.

Identical vectors are grouped once; the fit and the projection run over the distinct vectors, and the rows join back. Only small
moments meet: a count and one sum per dimension, then one centred product matrix per vector length, whose rows are added in as many
groups as there are dimensions. Centres are whole numbers next to the means, so centred products are whole numbers too: their sums in
doubles are exact up to 2^53, do not depend on the order of tasks, and the remainder of the centring is taken off exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import remove_dirs, write_and_read

GRID = 256
HOT_SHARE, HOT_ROWS = 1000, 1000  # vectors with over 1/1000 of all rows (fewer than 1000 of them) and over 1000 rows join by broadcast
FLAT = 1e-13  # a variance below this share of the largest counts as none
LONG = 2**63


@dataclass(frozen=True)
class Fit:
    """What whitens the vectors of one length: total weight and sums (exact), components as rows, their variances and shares."""

    weight: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    explained: list[float | None]

    def centre(self) -> np.ndarray:
        return np.array([_nearest(s, self.weight) for s in self.sums], dtype=np.int64)


def _nearest(total: int, count: int) -> int:
    return (2 * total + count) // (2 * count)


def grid_vectors(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, x): every entry as a whole number of 1/256, rounded down. Rows that are null or empty or hold entries that are null, not
    finite or too large for a long are left out."""

    def scaled(c: Column) -> Column:
        return c.cast("double") * GRID

    def usable(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(scaled(c)) < F.lit(float(LONG)))

    rows = df.select(F.col(id_col).alias("id"), F.col(vector).alias("v")).filter((F.size("v") > 0) & F.forall("v", usable))
    return rows.select("id", F.transform("v", lambda c: F.floor(scaled(c)).cast("bigint")).alias("x"))


def _by_length(batch: pa.RecordBatch, column: str, kind: type) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix of those rows) for each length of the list column."""
    lists = batch.column(column)
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        at = starts[rows][:, None] + np.arange(length)
        yield int(length), rows, flat[at].astype(kind)


def _sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Total weight and weighted sum of every dimension, for each vector length, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            w = batch.column("weight").to_numpy()
            for length, rows, x in _by_length(batch, "x", np.int64):
                total = int(w[rows].sum())
                small = np.abs(x.astype(np.float64)).max() * total < 2.0**62
                s = (w[rows] @ x if small else w[rows].astype(object) @ x.astype(object)).astype(object)
                weights[length] = weights.get(length, 0) + total
                sums[length] = sums.get(length, 0) + s
        for length in weights:
            values = [str(int(s)) for s in sums[length]]
            yield pa.RecordBatch.from_pydict({"length": pa.array([length] * length, pa.int32()), "i": pa.array(range(length), pa.int32()),
                                              "weight": pa.array([weights[length]] * length, pa.int64()), "total": values})

    parts = distinct.mapInArrow(run, "length int, i int, weight bigint, total string")
    out = parts.groupBy("length", "i").agg(F.sum("weight").alias("weight"), F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total"))
    found: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(out.collect(), key=lambda r: (r.length, r.i)):  # one number per dimension
        found.setdefault(r.length, (r.weight, []))[1].append(int(r.total))
    return found


def _products(distinct: DataFrame, column: str, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Weighted products of all pairs of dimensions about the given centres, for each vector length."""
    kind = next(iter(centres.values())).dtype.type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[int, np.ndarray] = {}
        for batch in batches:
            w = batch.column("weight").to_numpy().astype(np.float64)
            for length, rows, x in _by_length(batch, column, kind):
                y = (x - centres[length]).astype(np.float64)
                grams[length] = grams.get(length, 0.0) + (y * w[rows, None]).T @ y
        for length, gram in grams.items():
            yield pa.RecordBatch.from_pydict({"length": pa.array([length] * length, pa.int32()), "i": pa.array(range(length), pa.int32()),
                                              "row": pa.array(list(gram), pa.list_(pa.float64()))})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"length": rows["length"][:1], "i": rows["i"][:1], "row": [np.sum(np.stack(rows["row"].to_list()), axis=0)]})

    schema = "length int, i int, row array<double>"
    summed = distinct.mapInArrow(run, schema).groupBy("length", "i").applyInPandas(add, schema)
    found: dict[int, list] = {}
    for r in sorted(summed.collect(), key=lambda r: (r.length, r.i)):  # one matrix per length
        found.setdefault(r.length, []).append(r.row)
    return {length: np.array(rows) for length, rows in found.items()}


def _fit(gram: np.ndarray, centre: np.ndarray, weight: int, sums: list[int], components: int) -> Fit:
    """Covariance from products about whole centres, less the exact remainder of the centring, then its eigenvectors."""
    rest = np.array([s - weight * int(c) for s, c in zip(sums, centre)], dtype=object)  # |rest| <= weight / 2
    whole = np.array([[int(g) for g in row] for row in gram], dtype=object)
    covariance = ((whole * weight - np.outer(rest, rest)) / (weight * weight)).astype(np.float64)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:components]
    trace, least = float(np.trace(covariance)), max(float(values[-1]), 0.0) * FLAT
    variances = np.where(values[order] > least, values[order], 0.0)
    explained = [float(max(v, 0.0) / trace) if trace > 0 else None for v in values[order]]
    return Fit(weight, sums, vectors[:, order].T.copy(), variances, explained)


def fit(distinct: DataFrame, components: int) -> dict[int, Fit]:
    """One fit per vector length over (x, weight); the driver holds one matrix of moments per length and nothing per row."""
    sums = _sums(distinct)
    if not sums:
        return {}
    centres = {length: np.array([_nearest(s, weight) for s in totals], dtype=np.int64) for length, (weight, totals) in sums.items()}
    grams = _products(distinct, "x", centres)
    return {length: _fit(grams[length], centres[length], weight, totals, components) for length, (weight, totals) in sums.items()}


def _deviations(x: np.ndarray, weight: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (weight * x - sum)^2, exactly; None where it does not fit into a long."""
    width = max(abs(s) for s in sums) + weight * int(np.abs(x.astype(np.float64)).max())
    if width * width * x.shape[1] < LONG:
        d = weight * x - np.array(sums, dtype=np.int64)
        return np.einsum("ij,ij->i", d, d).tolist()
    d = weight * x.astype(object) - np.array(sums, dtype=object)
    return [int(s) if s < LONG else None for s in (d * d).sum(axis=1)]


def project(distinct: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """(x, rows, weight, n, deviation, whitened, explained) of every distinct vector; components without variance are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            weight, deviation, whitened, explained = [0] * n, [None] * n, [None] * n, [None] * n
            for length, rows, x in _by_length(batch, "x", np.int64):
                f = fits[length]
                centre = f.centre()
                rest = np.array([(s - f.weight * int(c)) / f.weight for s, c in zip(f.sums, centre)])
                flat = f.variances <= 0
                scale = 1 / np.sqrt(np.where(flat, 1.0, f.variances))
                w = ((x - centre) - rest) @ f.components.T * scale
                for k, row, d in zip(rows.tolist(), w.tolist(), _deviations(x, f.weight, f.sums)):
                    weight[k], deviation[k], explained[k] = f.weight, d, f.explained
                    whitened[k] = [None if no else v for v, no in zip(row, flat)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("x"), batch.column("rows"), batch.column("weight"), pa.array(weight, pa.int64()), pa.array(deviation, pa.int64()),
                 pa.array(whitened, pa.list_(pa.float64())), pa.array(explained, pa.list_(pa.float64()))],
                names=["x", "rows", "weight", "n", "deviation", "whitened", "explained"])

    return distinct.mapInArrow(run, "x array<bigint>, rows bigint, weight bigint, n bigint, deviation bigint, whitened array<double>, explained array<double>")


def identity_error(projected: DataFrame, fits: dict[int, Fit]) -> float:
    """Largest absolute entry of the whitened vectors' own covariance less the identity, over the components with variance."""
    kept = projected.select(F.filter("whitened", lambda c: c.isNotNull()).alias("y"), "weight", F.size("x").alias("length"))
    worst = 0.0
    for length, f in fits.items():
        live = int((f.variances > 0).sum())
        if live:
            rows = kept.filter(F.col("length") == length)
            means = np.array(rows.agg(*[F.sum(F.col("weight") * F.col("y")[k]) / f.weight for k in range(live)]).first())
            covariance = _products(rows, "y", {live: means})[live] / f.weight
            worst = max(worst, float(np.abs(covariance - np.eye(live)).max()))
    return worst


def whiten(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = 4, weights: str = "one") -> DataFrame:
    """Per row with a usable vector and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds null or non-finite entries (or ones too large for a long) give nothing; an empty table
    gives no rows. Repeated rows each give theirs. Vectors of different lengths are fitted apart, and a vector gives no more
    components than it has entries. ``weights="one"`` fits every distinct vector once, ``"count"`` as often as it occurs. A
    component without variance is null in ``whitened`` and 0 in ``explained`` (null if nothing varies). Where two variances are
    equal, their components are some pair of axes of that plane. Other columns are not read, so their names cannot clash.
    """
    if weights not in ("one", "count"):
        raise ValueError(f"weights is 'one' or 'count', not {weights!r}")
    spark, made = df.sparkSession, []
    rows = grid_vectors(df, id_col, vector)
    weight = F.lit(1).cast("bigint") if weights == "one" else F.col("rows")
    distinct = write_and_read(rows.groupBy("x").agg(F.count("*").alias("rows")).withColumn("weight", weight), made)
    fits = fit(distinct, components)
    projected = write_and_read(project(distinct, fits))
    error = identity_error(projected, fits)
    total = projected.agg(F.sum("rows")).first()[0] or 0
    remove_dirs(spark, made)

    hot = F.col("rows") > max(HOT_ROWS, total // HOT_SHARE)
    answers = projected.select("x", "rows", "n", "deviation", "whitened", "explained")
    joined = rows.join(answers.filter(~hot), "x")
    if not projected.filter(hot).isEmpty():  # fewer than HOT_SHARE vectors, whatever the table's size
        common = F.broadcast(answers.filter(hot))
        joined = rows.join(common, "x").unionByName(rows.join(common.select("x"), "x", "left_anti").join(answers.filter(~hot), "x"))
    each = joined.select("id", "n", "deviation", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select(F.col("id").alias(id_col), (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
                       F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), F.lit(error).alias("identity_error"))
