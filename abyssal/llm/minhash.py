"""MinHash near-deduplication: universal hash minima, banding, signature check, exact confirmation, connected components.

Texts are lower-cased (A-Z) and split at blanks; a document's set holds its distinct shingles of ``words`` words. Documents
whose sets have a Jaccard similarity of ``percent`` % or more are linked, found through `MINIMA` universal hash minima in bands
of `ROWS` (a pair at 0.8 is missed with a chance under 1e-5) and confirmed on the full sets. Shingles are compared by 64-bit
hashes of their words.

Documents with equal sets are one class, compared once. Each class is confirmed against its best bucket partner first; the links
found join classes into components. Buckets that still hold several components are then searched whole: their members' full sets
meet in blocks of bounded size, and of the links between components a forest leaves each block. So no link that a bucket offers is
lost and no group is expanded into all its pairs.

Null ids, null or empty texts: no links. Rows that share an id are one document. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import remove_dirs, write_and_read
from abyssal.llm.batches import bound_batches, few_or_hashed, return_memory
from abyssal.llm.components import connected_components

MINIMA, ROWS = 100, 4
BANDS = MINIMA // ROWS
#: A pair at similarity 0.8 agrees in 80 of 100 minima on average, with a standard deviation of 4.
LEAST_AGREE = 0.55
BLOCK = 512  # members of a bucket that meet as many others at once
SLICE = 1 << 16  # shingles hashed at once, or those of one text
ROWS_AT_ONCE = 200
CACHE = 1 << 18  # word hashes that a task remembers


def word_hashes(text: str, cache: dict[bytes, int]) -> np.ndarray:
    words = text.encode().lower().split()
    if len(cache) > CACHE:
        cache.clear()
    for w in set(words).difference(cache):
        cache[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, words: int, cache: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct shingle hashes; with fewer words than a shingle needs, the whole sequence is one."""
    h = word_hashes(text or "", cache)
    if not len(h):
        return h
    k = min(words, len(h))
    mixed = np.zeros(len(h) - k + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            mixed = (mixed ^ h[i : len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        mixed += np.uint64(k)
    return np.unique(mixed)


def hash_family(seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add functions on 32-bit values; odd factors."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, MINIMA, dtype=np.uint32)


def minima(sets: list[np.ndarray], family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The smallest value of every function over each of the non-empty sets."""
    x = ((np.concatenate(sets) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets[:-1]]))).astype(np.int64)
    return np.stack([np.minimum.reduceat(x * a + b, starts) for a, b in zip(*family)], axis=1)


def _groups(sets: list[np.ndarray]) -> Iterator[list[int]]:
    """Runs of sets with about `SLICE` shingles together."""
    group, size = [], 0
    for i, s in enumerate(sets):
        if len(s):
            group.append(i)
            size += len(s)
            if size >= SLICE:
                yield group
                group, size = [], 0
    if group:
        yield group


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """Per document: id, n_shingles, set_key (128-bit hash of the set), agree (one byte of each minimum), bands."""

    @F.pandas_udf("n_shingles bigint, set_key binary, agree binary, bands array<bigint>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache: dict[bytes, int] = {}
        family = hash_family()
        try:
            for texts in batches:
                out = []
                for a in range(0, len(texts), ROWS_AT_ONCE):
                    sets = [shingle_set(t, words, cache) for t in texts.iloc[a : a + ROWS_AT_ONCE]]
                    found = [(len(s), None, None, None) for s in sets]
                    for group in _groups(sets):
                        for i, m in zip(group, minima([sets[i] for i in group], family)):
                            bands = [xxhash.xxh3_64_intdigest(m[k * ROWS : (k + 1) * ROWS].tobytes(), seed=k) - (1 << 63) for k in range(BANDS)]
                            found[i] = (len(sets[i]), xxhash.xxh3_128_digest(sets[i].tobytes()), (m & 0xFF).astype(np.uint8).tobytes(), bands)
                    out += found
                yield pd.DataFrame(out, columns=["n_shingles", "set_key", "agree", "bands"])
        finally:
            cache.clear()
            return_memory()

    return docs.select("id", sign("text").alias("s")).select("id", "s.*")


def agreement():
    """Column function of two signatures: how many minima agree, judged by one byte of each."""

    @F.pandas_udf("int")
    def agreed(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype="int32")
        x = np.frombuffer(b"".join(a), np.uint8).reshape(len(a), -1)
        return pd.Series((x == np.frombuffer(b"".join(b), np.uint8).reshape(len(a), -1)).sum(axis=1).astype(np.int32))

    return agreed


def similar(words: int, percent: int):
    """Column function: do two texts' full sets reach the similarity?"""

    @F.pandas_udf("boolean")
    def confirm(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        cache: dict[bytes, int] = {}
        try:
            for left, right in batches:
                out = []
                for a, b in zip(left, right):
                    x, y = shingle_set(a, words, cache), shingle_set(b, words, cache)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    out.append(100 * both >= percent * (len(x) + len(y) - both))
                yield pd.Series(out, dtype=bool)
        finally:
            cache.clear()
            return_memory()

    return confirm


def size_fits(a: Column, b: Column, percent: int) -> Column:
    """Sets of too different sizes cannot reach the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


@dataclass
class _Search:
    """What confirmations share: the texts, and the list of folders to remove."""

    texts: DataFrame
    made: list[str]
    words: int
    percent: int

    def texts_of(self, ids: DataFrame) -> DataFrame:
        ids = write_and_read(ids.distinct(), self.made)
        return self.texts.join(few_or_hashed(ids), "id", "left_semi")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (u, v) that reach the similarity on their full sets."""
        texts = write_and_read(self.texts_of(pairs.select(F.explode(F.array("u", "v")).alias("id"))), self.made)
        left = texts.select(F.col("id").alias("u"), F.col("text").alias("a"))
        right = texts.select(F.col("id").alias("v"), F.col("text").alias("b"))
        both = pairs.select("u", "v").join(left, "u").join(right, "v")
        return both.filter(similar(self.words, self.percent)("a", "b")).select("u", "v")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_shingles, component_id (smallest id reachable over links, itself included), kept (id = component_id).

    ``percent`` may not be under 80: the banding is laid out for that.
    """
    spark, made = docs.sparkSession, []
    bound_batches(spark)
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    signed = write_and_read(signatures(source, words))
    usable = signed.filter(F.col("id").isNotNull() & F.col("set_key").isNotNull())
    classes = write_and_read(usable.groupBy("set_key").agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    reps = usable.join(classes.select(F.col("rep").alias("id"), "set_key"), ["id", "set_key"]).dropDuplicates(["id", "set_key"])
    reps = write_and_read(reps.select("id", "n_shingles", "agree", "bands"), made)
    search = _Search(source.filter(F.col("id").isNotNull()), made, words, percent)
    in_buckets = _bucket_members(reps, made)
    first = search.confirmed(write_and_read(_best_partners(reps, in_buckets, percent), made))
    first = write_and_read(first, made)
    tied = _tied(usable, classes)
    edges = write_and_read(first.union(tied), made)
    parts = write_and_read(connected_components(edges), made)
    rest = write_and_read(_between_components(search, in_buckets, parts, made), made)
    if not rest.isEmpty():
        parts = connected_components(edges.union(rest))
    parts = write_and_read(parts)
    # the class stands for its members: set_key leads to the representative, the representative to its component
    keyed = write_and_read(classes.join(parts, F.col("rep") == F.col("node"), "left").select("set_key", F.coalesce("component", "rep").alias("component_id")))
    remove_dirs(spark, made)
    out = signed.select("id", "n_shingles", "set_key").join(keyed, "set_key", "left").join(parts, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "component_id", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


def _tied(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows that share an id but not a set tie their classes together."""
    several = usable.groupBy("id").agg(F.count_distinct("set_key").alias("n")).filter("n > 1").select("id")
    return usable.join(several, "id").join(classes, "set_key").select(F.col("id").alias("u"), F.col("rep").alias("v"))


def _bucket_members(reps: DataFrame, made: list[str]) -> DataFrame:
    """(band, id, least) of every bucket with two members or more; ``least`` is the bucket's smallest id."""
    rows = reps.select("id", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("size"), F.min("id").alias("least")).filter("size > 1")
    shared = write_and_read(shared, made)
    return write_and_read(rows.join(shared, "band"), made)


def _best_partners(reps: DataFrame, in_buckets: DataFrame, percent: int) -> DataFrame:
    """For each representative the bucket leader (a smaller id) that agrees most, if it agrees enough."""
    pairs = in_buckets.filter(F.col("id") != F.col("least")).groupBy("id", "least").agg(F.count("*").alias("shared"))
    u = reps.select("id", F.col("n_shingles").alias("n"), F.col("agree").alias("mine"))
    v = reps.select(F.col("id").alias("least"), F.col("n_shingles").alias("m"), F.col("agree").alias("theirs"))
    near = pairs.join(u, "id").join(v, "least").filter(size_fits(F.col("n"), F.col("m"), percent))
    near = near.withColumn("agreed", agreement()("mine", "theirs")).filter(F.col("agreed") >= LEAST_AGREE * MINIMA)
    best = near.groupBy("id").agg(F.max(F.struct("agreed", (-F.col("least")).alias("back"))).alias("best"))
    return best.select(F.col("id").alias("u"), (-F.col("best.back")).alias("v"))


def shingles_of(words: int):
    """Column function: a text's sorted shingle hashes, eight bytes each."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[bytes, int] = {}
        try:
            for texts in batches:
                yield pd.Series([shingle_set(t, words, cache).tobytes() for t in texts], dtype=object)
        finally:
            cache.clear()
            return_memory()

    return run


def _between_components(search: _Search, in_buckets: DataFrame, parts: DataFrame, made: list[str]) -> DataFrame:
    """Links (u, v) between components that share a bucket, enough of them to tell which components are one."""
    part = parts.select(F.col("node").alias("id"), "component")
    placed = in_buckets.join(part, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = write_and_read(placed.select("band", "id", "component"), made)
    mixed = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members")).filter("lo < hi")
    mixed = write_and_read(mixed.select("band", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")), made)
    rows = write_and_read(placed.join(mixed, "band"), made)
    texts = search.texts_of(rows.select("id"))
    sets = write_and_read(texts.select("id", shingles_of(search.words)("text").alias("shingles")), made)
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # a member goes to the block pairs that hold its own block: with itself and with every other one
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).join(sets, "id")
    dealt = rows.select("band", "lo", "hi", "own", "id", "component", "shingles").repartition("band", "lo", "hi")
    return dealt.sortWithinPartitions("band", "lo", "hi", "own", "id").mapInPandas(_compare_blocks(search.percent), "u bigint, v bigint").distinct()


def links_between(sets: list[np.ndarray], part: np.ndarray, side: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """A forest of links at ``percent`` % between different parts; with ``side``, of links between its two sides only.

    A member's intersections with all others come from the owners of its shingles, so they are exact.
    """
    n, sizes = len(sets), np.array([len(s) for s in sets])
    part = np.unique(part, return_inverse=True)[1]
    owner = np.repeat(np.arange(n), sizes)
    _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(shingle, kind="stable")
    owners, starts = owner[order], np.concatenate(([0], np.cumsum(np.bincount(shingle))))
    first, out = np.concatenate(([0], np.cumsum(sizes))), []
    for i in range(n - 1):
        fit = (part != part[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        fit[: i + 1] = False
        if side is not None:
            fit &= side != side[i]
        if not fit.any():
            continue
        mine = shingle[first[i] : first[i + 1]]
        begin, count = starts[mine], starts[mine + 1] - starts[mine]
        at = np.repeat(begin - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        both = np.bincount(owners[at], minlength=n)
        for j in np.flatnonzero(fit & (100 * both >= percent * (sizes + sizes[i] - both))):
            if part[j] != part[i]:
                out.append((i, int(j)))
                part[part == part[j]] = part[i]
    return out


def _compare_blocks(percent: int):
    """Streams over rows sorted by block pair; holds one block pair at a time."""

    def pairs(g: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(s, np.uint64) for s in g["shingles"]]
        side = g["own"].to_numpy() if g["lo"].iat[0] != g["hi"].iat[0] else None
        ids = g["id"].to_numpy()
        return pd.DataFrame([(ids[i], ids[j]) for i, j in links_between(sets, g["component"].to_numpy(), side, percent)], columns=["u", "v"], dtype="int64")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            key = pdf["band"].astype(str) + "/" + pdf["lo"].astype(str) + "/" + pdf["hi"].astype(str)
            starts = np.flatnonzero(np.append(True, key.to_numpy()[1:] != key.to_numpy()[:-1])) if len(pdf) else []
            for a, b in zip(starts[:-1], starts[1:]):
                if b - a > 1:
                    yield pairs(pdf.iloc[a:b])
            held = pdf.iloc[starts[-1] :] if len(starts) else None
        if held is not None and len(held) > 1:
            yield pairs(held)

    return run
