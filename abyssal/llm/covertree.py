"""Embedding near-dedup: exact threshold pairs by dual traversal of cover trees.

All distances are angles, a metric on directions. The top of the tree is spread over the cluster: pivots from a bounded sample
split the vectors into cells with known covering radii, and a vector is dealt only to the cell pairs that its distance to the
other cell's pivot leaves open (d <= covering radius + threshold). Cells are cut into blocks of bounded size, so that a cell that
holds a third of all rows is many tasks. In each block, nested levels with halving radii are built once: nodes of one level split
those of the level above.

A block pair is searched from the coarsest level down. A node pair is dropped when its centres are farther apart than the
threshold and both covering radii together; it is taken whole when even the sum stays within the threshold; else its children are
paired. Vectors are compared last, in double precision. Counts are summed and links are passed on as a spanning forest, so groups
of copies are never written out as pairs.

Vectors that are null or zero or hold null or non-finite components link with nothing, and vectors of different lengths not with
each other. Null ids: no links and a null component. Rows that share an id are one vector, the smallest of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import remove_dirs, write_and_read
from abyssal.llm.components import connected_components

BLOCK = 4096  # vectors in a block at most, on average
MOST_CELLS = 256  # pivots, a bounded sample
RADII = (0.5, 0.25, 0.125)
SAFE = 1e-6  # keeps rounding on the safe side of every bound


def unit(vectors: np.ndarray) -> np.ndarray:
    """Directions; by the largest component first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def angles(dots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(dots, -1.0, 1.0))


def _matrix(arrays: pd.Series) -> np.ndarray:
    return unit(np.stack(arrays.to_numpy()).astype(np.float64)) if len(arrays) else np.zeros((0, 1))


def levels(x: np.ndarray) -> np.ndarray:
    """For every vector its node on each level; nodes are numbered so that sorting by all levels puts each node together."""
    dots, n = x @ x.T, len(x)
    parent, out = np.zeros(n, np.int64), []
    for radius in RADII:
        near, node = dots >= math.cos(radius), np.full(n, -1)
        for i in range(n):
            if node[i] < 0:
                node[near[i] & (node < 0) & (parent == parent[i])] = i
        out.append(node)
        parent = node
    return np.stack(out, axis=1)


class Tree:
    """A block's vectors sorted by node, and per level the nodes' ranges, centres (mean directions) and covering radii."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, nodes: np.ndarray):
        order = np.lexsort(nodes.T[::-1])
        self.ids, self.x = ids[order], x[order]
        nodes, self.starts, self.centre, self.radius = nodes[order], [], [], []
        changed = np.zeros(len(ids), bool)
        changed[0] = True
        for column in nodes.T:
            changed[1:] |= column[1:] != column[:-1]
            start = np.flatnonzero(changed)
            mean = np.add.reduceat(self.x, start, axis=0)
            mean /= np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-12)
            sizes = np.diff(np.append(start, len(ids)))
            least = np.minimum.reduceat(np.einsum("ij,ij->i", self.x, np.repeat(mean, sizes, axis=0)), start)
            self.starts.append(np.append(start, len(ids)))
            self.centre.append(mean)
            self.radius.append(np.where(sizes > 1, angles(least) + SAFE, 0.0))

    def children(self, level: int, node: int) -> np.ndarray:
        a, b = np.searchsorted(self.starts[level + 1], self.starts[level][node : node + 2])
        return np.arange(a, b)


class Search:
    """Dual traversal of two trees, or of one with itself; fills link counts and roots of a forest for each side."""

    def __init__(self, left: Tree, right: Tree, cosine: float):
        self.left, self.right, self.same = left, right, left is right
        self.cosine, self.limit = cosine, math.acos(cosine)
        self.count = [np.zeros(len(t.ids), np.int64) for t in (left, right)]
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def run(self) -> None:
        """Coarsest nodes against coarsest nodes, single vectors apart from larger nodes, whose bounds are wider."""
        a, b = self.left, self.right
        for i in self._by_size(a):
            for j in self._by_size(b):
                if not len(i) or not len(j):
                    continue
                reach = self.limit + a.radius[0][i].max() + b.radius[0][j].max() + SAFE
                dots = a.centre[0][i].astype(np.float32) @ b.centre[0][j].astype(np.float32).T
                u, v = np.nonzero(dots >= math.cos(min(reach, math.pi)) - 1e-5)
                self._pairs(0, i[u], j[v])

    @staticmethod
    def _by_size(t: Tree) -> tuple[np.ndarray, np.ndarray]:
        return np.flatnonzero(t.radius[0] == 0), np.flatnonzero(t.radius[0] > 0)

    def _pairs(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        if self.same:
            single = np.diff(self.left.starts[level])[i] == 1
            keep = (i < j) | ((i == j) & ~single)
            i, j = i[keep], j[keep]
        a, b, step = self.left, self.right, 50_000
        for at in range(0, len(i), step):
            p, q = i[at : at + step], j[at : at + step]
            d = angles(np.einsum("ij,ij->i", a.centre[level][p], b.centre[level][q]))
            if self.same:
                d[p == q] = 0.0
            both = a.radius[level][p] + b.radius[level][q]
            whole = d + both + SAFE <= self.limit
            for s, t in zip(p[whole], q[whole]):
                self._whole(level, s, t)
            open_ = ~whole & (d - both - SAFE <= self.limit)
            for s, t in zip(p[open_], q[open_]):
                if level + 1 < len(RADII):
                    down, over = a.children(level, s), b.children(level, t)
                    self._pairs(level + 1, np.repeat(down, len(over)), np.tile(over, len(down)))
                else:
                    self._vectors(s, t)

    def _whole(self, level: int, s: int, t: int) -> None:
        a0, a1 = self.left.starts[level][s : s + 2]
        b0, b1 = self.right.starts[level][t : t + 2]
        own = self.same and s == t
        self.count[0][a0:a1] += b1 - b0 - own
        if not own:
            self.count[1][b0:b1] += a1 - a0
        first = self.left.ids[a0]
        self._edge(first, self.left.ids[a0:a1])
        self._edge(first, self.right.ids[b0:b1])

    def _edge(self, root: int, ids: np.ndarray) -> None:
        self.edges.append((np.full(len(ids), root), ids))

    def _vectors(self, s: int, t: int) -> None:
        last = len(RADII) - 1
        a0, a1 = self.left.starts[last][s : s + 2]
        b0, b1 = self.right.starts[last][t : t + 2]
        linked = self.left.x[a0:a1] @ self.right.x[b0:b1].T >= self.cosine
        own = self.same and s == t
        if own:
            np.fill_diagonal(linked, False)
        if not linked.any():
            return
        self.count[0][a0:a1] += linked.sum(axis=1)
        if not own:
            self.count[1][b0:b1] += linked.sum(axis=0)
        rows, cols = self.left.ids[a0:a1], self.right.ids[b0:b1]
        todo = linked.any(axis=1)
        while todo.any():
            seed = int(todo.argmax())
            frontier, seen = np.zeros(len(rows), bool), np.zeros(len(cols), bool)
            frontier[seed] = True
            while frontier.any():
                todo &= ~frontier
                self._edge(rows[seed], rows[frontier])
                new = linked[frontier].any(axis=0) & ~seen
                seen |= new
                self._edge(rows[seed], cols[new])
                frontier = linked[:, new].any(axis=1) & todo

    def result(self) -> pd.DataFrame:
        """(vec_id, n_links, root) of the vectors with links here."""
        ids = self.left.ids if self.same else np.concatenate((self.left.ids, self.right.ids))
        n = self.count[0] + self.count[1] if self.same else np.concatenate(self.count)
        root = {int(v): int(v) for v in ids[n > 0]}

        def find(v: int) -> int:
            while root[v] != v:
                root[v] = root[root[v]]
                v = root[v]
            return v

        for u, v in self.edges:
            for x, y in zip(u.tolist(), v.tolist()):
                x, y = find(x), find(y)
                if x != y:
                    root[max(x, y)] = min(x, y)
        hit = np.flatnonzero(n > 0)
        return pd.DataFrame({"vec_id": ids[hit], "n_links": n[hit], "root": [find(int(v)) for v in ids[hit]]}, dtype="int64")


def _streamed(work, keys: list[str]):
    """Applies ``work`` to every key's rows of partitions sorted by the keys; holds one key's rows at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            if not len(pdf):
                continue
            k = pdf[keys].to_numpy()
            cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
            for part in np.split(np.arange(len(pdf)), cuts):
                rows = pdf.iloc[part]
                if held and tuple(held[-1][keys].iloc[-1]) != tuple(rows[keys].iloc[0]):
                    yield work(pd.concat(held, ignore_index=True))
                    held = []
                held.append(rows)
        if held:
            yield work(pd.concat(held, ignore_index=True))

    return run


def _usable(vectors: DataFrame, id_col: str, vector_col: str, made: list[str]) -> DataFrame:
    """(id, v) of the vectors that can link."""
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    # ids first: of rows that share one the smallest stands, usable or not
    rows = write_and_read(rows.groupBy("id").agg(F.min("v").alias("v")), made)
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    zero = ~F.exists("v", lambda c: c != 0)
    return rows.filter(~bad & ~zero)


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """Per vector: id, n_links (other vectors at ``cosine`` or more), component_id (smallest id reachable), kept (id = component_id).

    Vectors of different lengths have no cosine and do not link; each length is searched by itself.
    """
    spark, made = vectors.sparkSession, []
    rows = write_and_read(_usable(vectors, id_col, vector_col, made), made)
    ids = vectors.select(F.col(id_col).cast("bigint").alias("id")).distinct()
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("total")).filter("total > 1").orderBy("n").collect()
    found = [_links(rows.filter(F.size("v") == r["n"]), r["total"], cosine, block, made) for r in lengths]
    if not found:
        remove_dirs(spark, made)
        return ids.select(F.col("id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    links = reduce(DataFrame.unionByName, found)
    counts = write_and_read(links.groupBy("vec_id").agg(F.sum("n_links").alias("n_links")))
    parts = write_and_read(connected_components(links.select(F.col("vec_id").alias("u"), F.col("root").alias("v"))))
    remove_dirs(spark, made)
    out = ids.join(counts, ids["id"] == counts["vec_id"], "left").join(parts, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    n = F.coalesce("n_links", F.lit(0)).cast("bigint")
    return out.select(F.col("id").alias(id_col), n.alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))


def _links(rows: DataFrame, total: int, cosine: float, block: int, made: list[str]) -> DataFrame:
    """(vec_id, n_links, root) among vectors (id, v) of one length, written; links of a block pair leave as a forest."""
    spark = rows.sparkSession
    cells = min(MOST_CELLS, -(-total // block))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(cells).collect()
    pivots = unit(np.array([r["v"] for r in sample]))
    limit = math.acos(cosine)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            far = angles(_matrix(pdf["v"]) @ pivots.T) if len(pdf) else np.zeros((0, len(pivots)))
            yield pd.DataFrame({"id": pdf["id"], "v": pdf["v"], "cell": far.argmin(axis=1), "far": list(far.astype(np.float32))})

    assigned = write_and_read(rows.mapInPandas(assign, "id bigint, v array<double>, cell int, far array<float>"), made)
    own = F.get("far", F.col("cell"))
    extent = {r["cell"]: r for r in assigned.groupBy("cell").agg(F.max(own).alias("radius"), F.count("*").alias("n")).collect()}
    # a row for each cell, of which there are `MOST_CELLS` at most
    listed = [(c, float(r["radius"]) + 1e-5 + limit, -(-r["n"] // block)) for c, r in sorted(extent.items())]
    reach = spark.createDataFrame(listed, "other int, reach double, blocks int")
    split = F.create_map(*[x for c, _, b in listed for x in (F.lit(c), F.lit(b))])
    placed = assigned.withColumn("block", F.pmod(F.xxhash64("id"), split[F.col("cell")]).cast("int"))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes = levels(_matrix(pdf["v"]))
        return pd.DataFrame({"id": pdf["id"], "v": pdf["v"], "cell": pdf["cell"], "block": pdf["block"], "far": pdf["far"], "nodes": list(nodes)})

    schema = "id bigint, v array<double>, cell int, block int, far array<float>, nodes array<bigint>"
    grown = placed.select("id", "v", "cell", "block", "far").repartition("cell", "block").sortWithinPartitions("cell", "block", "id")
    grown = write_and_read(grown.mapInPandas(_streamed(grow, ["cell", "block"]), schema), made)
    # each vector goes to the blocks of the cells it can reach; both sides of a block pair meet under its key
    near = grown.join(F.broadcast(reach), F.get("far", F.col("other")) <= F.col("reach"))
    near = near.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    first = (F.col("cell") < F.col("other")) | ((F.col("cell") == F.col("other")) & (F.col("block") <= F.col("partner")))
    mine, theirs = F.struct(F.col("cell").alias("c"), F.col("block").alias("b")), F.struct(F.col("other").alias("c"), F.col("partner").alias("b"))
    lo, hi = F.when(first, mine).otherwise(theirs), F.when(first, theirs).otherwise(mine)
    near = near.select("id", "v", "nodes", lo["c"].alias("c1"), lo["b"].alias("b1"), hi["c"].alias("c2"), hi["b"].alias("b2"), first.alias("left"))
    keys = ["c1", "b1", "c2", "b2"]

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        trees = []
        for side in (True, False):
            part = pdf[pdf["left"] == side]
            if len(part):
                trees.append(Tree(part["id"].to_numpy(), _matrix(part["v"]), np.stack(part["nodes"].to_numpy())))
        if pdf[["c1", "b1"]].iloc[0].tolist() == pdf[["c2", "b2"]].iloc[0].tolist():
            trees = trees[:1] * 2
        if len(trees) < 2:
            return pd.DataFrame({"vec_id": [], "n_links": [], "root": []}, dtype="int64")
        search = Search(trees[0], trees[1], cosine)
        search.run()
        return search.result()

    dealt = near.repartition(*keys).sortWithinPartitions(*keys, "id")
    return write_and_read(dealt.mapInPandas(_streamed(compare, keys), "vec_id bigint, n_links bigint, root bigint"), made)
