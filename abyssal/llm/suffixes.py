"""Suffix-array dedup: removes bytes covered by a string of `LENGTH` bytes that also starts somewhere else.

Suffixes are only sorted where a repeat is possible. Every window of `LENGTH` bytes is represented by an anchor in it, the start of
its `GRAM`-byte string with the smallest hash (the first of equal ones); equal windows have equal anchors at equal places. The
anchors' strings are the first buckets. A bucket of one anchor is settled. So is an anchor whose whole surroundings (all windows
that hold it) occur again: all its windows are repeats.

What is left goes through bucket-pointer refinement, bucket by bucket: the suffixes at all window starts around the bucket's anchors
get bucket numbers by their first `INITIAL` bytes; then suffixes are sorted by their own bucket number and the one `INITIAL` bytes
later, and, with the numbers of that sort, by the one twice as far on, which orders them to `LENGTH` bytes. Suffixes alone in a
bucket leave at once. Window starts that still share a bucket are repeats.

Buckets of more than `LARGEST` different surroundings are first refined by Spark: the window starts are halved, and each half is
a bucket of those anchors that agree on the bytes all its windows hold. Halves whose surroundings occur again are settled, halves
alone in their bucket too, so what is left shrinks until buckets are small or a half is a single window. No bucket is ever
collected whole.

Texts are UTF-8 bytes; null counts as empty. Equal texts (by a 128-bit hash) are one text with copies; one of them is read. Rows
that repeat id and text are copies too. Texts under `LENGTH` bytes lose nothing. Ids may be null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import remove_dirs, write_and_read
from abyssal.llm.batches import bound_batches

LENGTH = 400
GRAM = 32
REACH = LENGTH - GRAM  # an anchor is at most so far behind its window's start
INITIAL = 100
LARGEST = 1024
BLOCK = 1 << 19  # bytes that are hashed at once
BASE = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Polynomial hashes mod 2^64 of all strings of the given powers of two, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    out, size, factor = {1: h}, 1, BASE
    while size < max(sizes):
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = 2 * size, factor * factor % (1 << 64)
        out[size] = h
    return [out[s] for s in sizes]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all windows, and the hashes of their strings."""
    data, places, found = np.frombuffer(text, np.uint8), [], []
    for a in range(0, len(text) - LENGTH + 1, BLOCK):
        grams = mixed(gram_hashes(data[a : a + BLOCK + LENGTH - 1], (GRAM,))[0])
        # the place in the low bits makes the first of equal hashes the smallest
        least = (grams & ~np.uint64(0xFFFFF)) | np.arange(len(grams), dtype=np.uint64)
        size = 1
        while 2 * size <= REACH + 1:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        rest = REACH + 1 - size
        least = np.minimum(least[: len(least) - rest], least[rest:])
        at = np.unique(least & np.uint64(0xFFFFF)).astype(np.int64)
        places.append(at + a)
        found.append(grams[at])
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(found)[first].view(np.int64)


def window_range(place, size):
    """First and last window start that holds the anchor, relative to it."""
    return np.maximum(-REACH, -place), np.minimum(0, size - LENGTH - place)


def two_longs(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("a"), F.xxhash64(F.lit("text"), text).alias("b")]


def _find_anchors():
    @F.pandas_udf("size bigint, place array<int>, core array<bigint>, s1 array<bigint>, s2 array<bigint>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for t in texts:
                text = t.encode()
                if len(text) < LENGTH:
                    out.append((len(text), [], [], [], []))
                    continue
                place, core = anchors(text)
                lo, hi = window_range(place, len(text))
                spans = [two_longs(xxhash.xxh3_128_digest(text[p + x : p + y + LENGTH], seed=-x)) for p, x, y in zip(place.tolist(), lo.tolist(), hi.tolist())]
                s = np.array(spans, np.int64)
                out.append((len(text), place.astype(np.int32), core, s[:, 0], s[:, 1]))
            yield pd.DataFrame(out, columns=["size", "place", "core", "s1", "s2"])

    return run


def _cut():
    """Surroundings of places in a text."""

    @F.pandas_udf("array<binary>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, places in batches:
            out = []
            for t, ps in zip(texts, places):
                text = t.encode()
                out.append([text[max(0, p - REACH) : p + LENGTH] for p in ps])
            yield pd.Series(out)

    return run


def repeated_windows(key: np.ndarray, lo: np.ndarray, hi: np.ndarray, left: np.ndarray, around: list[bytes]) -> list[np.ndarray]:
    """For each row the window starts (flags from lo to hi) that another row of its bucket shares: bucket-pointer refinement."""
    pieces = [t[f + x : f + y + LENGTH] for t, f, x, y in zip(around, left.tolist(), lo.tolist(), hi.tolist())]
    sizes = np.array([len(p) for p in pieces])
    starts = np.concatenate(([0], np.cumsum(sizes)))
    data = np.frombuffer(b"".join(pieces), np.uint8)
    h64, h32, h4 = gram_hashes(data, (64, 32, 4))
    n = len(data) - INITIAL + 1
    power = [pow(BASE, e, 1 << 64) for e in (36, 4)]
    first = h64[:n] * np.uint64(power[0]) + h32[64 : 64 + n] * np.uint64(power[1]) + h4[96 : 96 + n]
    row = np.repeat(np.arange(len(pieces)), sizes)[:n]
    place = np.arange(n) - starts[row]
    first ^= mixed(key[row].view(np.uint64) ^ ((lo[row] + place + 1000).astype(np.uint64) * np.uint64(BASE)))
    bucket, several = _buckets(mixed(first))
    window = place <= (hi - lo)[row]
    alive = np.flatnonzero(window)
    for step in range(0, LENGTH, INITIAL):
        alive = alive[several[alive + step]]
    pointer = np.zeros(n, np.int64)
    part = np.unique(np.concatenate((alive, alive + 2 * INITIAL)))
    pointer[part], shared = _buckets((bucket[part] << 32) | bucket[part + INITIAL])
    alive = alive[shared[np.searchsorted(part, alive)] & shared[np.searchsorted(part, alive + 2 * INITIAL)]]
    flags = np.zeros(n, bool)
    flags[alive] = _buckets((pointer[alive] << 32) | pointer[alive + 2 * INITIAL])[1]
    return [flags[s : s + y - x + 1] for s, x, y in zip(starts.tolist(), lo.tolist(), hi.tolist())]


def _buckets(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers after sorting by key, and whether the bucket has several members."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.cumsum(new) - 1
    size = np.bincount(number) if len(keys) else np.zeros(0, np.int64)
    bucket, several = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    bucket[order], several[order] = number, size[number] > 1
    return bucket, several


def _refine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by bucket; as many whole buckets at a time as a batch has."""

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        key, lo, hi, left, at = (rows[c].to_numpy(np.int64) for c in ("key", "lo", "hi", "left", "place"))
        flags = repeated_windows(key, lo, hi, left, rows["around"].tolist())
        a, b, solo, out = rows["a"].to_numpy(), rows["b"].to_numpy(), rows["solo"].to_numpy(), []
        for i in np.flatnonzero(solo):
            edge = np.flatnonzero(np.diff(np.concatenate(([0], flags[i].view(np.int8), [0]))))
            for x, y in zip(edge[::2].tolist(), edge[1::2].tolist()):
                out.append((a[i], b[i], at[i] + lo[i] + x, at[i] + lo[i] + y - 1 + LENGTH))
        return pd.DataFrame(out, columns=["a", "b", "start", "end"], dtype="int64")

    held = None
    for pdf in batches:
        if not len(pdf):
            continue
        rows = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        key = rows["key"].to_numpy()
        last = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
        if last:
            yield settle(rows.iloc[:last])
        held = rows.iloc[last:]
    if held is not None:
        yield settle(held)


ROW = ["key", "a", "b", "place", "lo", "hi", "left", "around", "solo"]


def _halves():
    """Hashes of the bytes that all windows of a half hold, and of all bytes that a row's windows in it cover."""

    @F.pandas_udf("core bigint, h1 bigint, h2 bigint")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            out = []
            for key, around, left, lo, hi, first, last in zip(*(c.tolist() for c in columns)):
                core = around[left + last : left + first + LENGTH]
                core = xxhash.xxh3_64_intdigest(core, seed=(key ^ ((first + 1000) << 20)) % (1 << 64)) - (1 << 63)
                out.append((core, *two_longs(xxhash.xxh3_128_digest(around[left + lo : left + hi + LENGTH], seed=-lo))))
            yield pd.DataFrame(out, columns=["core", "h1", "h2"], dtype="int64")

    return run


def _split_large(rows: DataFrame, largest: int, made: list[str]) -> tuple[DataFrame, DataFrame]:
    """Small buckets made of large ones, and the covered ranges (a, b, start, end) that were settled on the way."""
    small, settled = [], []
    while not rows.isEmpty():
        middle = F.floor((F.col("from") + F.col("to")) / 2).cast("int")
        lower = F.struct(F.col("from").alias("f"), middle.alias("t"))
        upper = F.struct((middle + 1).alias("f"), F.col("to").alias("t"))
        parts = rows.withColumn("_c", F.explode(F.array(lower, upper))).withColumn("from", F.col("_c.f")).withColumn("to", F.col("_c.t")).drop("_c")
        parts = parts.withColumn("lo", F.greatest("lo", "from")).withColumn("hi", F.least("hi", "to")).filter(F.col("lo") <= F.col("hi"))
        hashed = parts.withColumn("_h", _halves()("key", "around", "left", "lo", "hi", "from", "to"))
        hashed = write_and_read(hashed.withColumn("key", F.col("_h.core")).withColumn("h1", F.col("_h.h1")).withColumn("h2", F.col("_h.h2")).drop("_h"), made)
        covers = write_and_read(hashed.groupBy("key", "h1", "h2").agg(F.count("*").alias("n")), made)
        sizes = write_and_read(covers.groupBy("key").agg(F.count("*").alias("size")), made)
        named = hashed.join(covers.join(sizes, "key"), ["key", "h1", "h2"])
        named = write_and_read(named, made)
        done = named.filter((F.col("n") > 1) & F.col("solo"))
        settled.append(done.select("a", "b", (F.col("place") + F.col("lo")).alias("start"), (F.col("place") + F.col("hi") + LENGTH).alias("end")))
        # one row of each surroundings goes on; it asks for a result only if it is alone with them
        one = named.filter("size > 1 AND n = 1").union(named.filter("size > 1 AND n > 1").dropDuplicates(["key", "h1", "h2"]))
        one = write_and_read(one.withColumn("solo", F.col("solo") & (F.col("n") == 1)), made)
        small.append(one.filter(F.col("size") <= largest).select(ROW))
        rows = one.filter(F.col("size") > largest).select(*ROW, "from", "to")
    return _union(small), _union(settled)


def _union(frames: list[DataFrame]) -> DataFrame | None:
    out = None
    for f in frames:
        out = f if out is None else out.union(f)
    return out


def repeats(docs: DataFrame, largest: int = LARGEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per distinct text (a, b: its hash): copies, and the covered ranges (start, end) in bytes, which may overlap."""
    spark, made = docs.sparkSession, []
    bound_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"), *text_key(text))
    found = source.select("a", "b", "id", _find_anchors()("text").alias("f")).select("a", "b", "id", "f.*")
    found = write_and_read(found, made)
    texts = write_and_read(found.groupBy("a", "b").agg(F.count("*").alias("copies"), F.min("id").alias("rep")))
    each = found.select("a", "b", "size", F.explode(F.arrays_zip("place", "core", "s1", "s2")).alias("x")).select("a", "b", "size", "x.*")
    spans = each.groupBy("s1", "s2").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("core", "a", "b", "place", "size")])
    spans = write_and_read(spans, made)
    sizes = write_and_read(spans.groupBy("core").agg(F.count("*").alias("spans")).filter("spans > 1"), made)
    open_ = write_and_read(spans.join(sizes, "core"), made)
    # all windows around anchors whose surroundings occur again
    again = write_and_read(spans.filter("n > 1").select("s1", "s2"), made)
    lo, hi = F.greatest(F.lit(-REACH), -F.col("place")), F.least(F.lit(0), F.col("size") - LENGTH - F.col("place"))
    whole = each.join(again, ["s1", "s2"]).select("a", "b", (F.col("place") + lo).alias("start"), (F.col("place") + hi + LENGTH).alias("end"))
    # the others' bytes, read from one row of each text
    asked = open_.groupBy("a", "b").agg(F.collect_list(F.struct("place", "core", "spans", "size", (F.col("n") == 1).alias("solo"))).alias("r"))
    asked = write_and_read(asked.join(texts.select("a", "b", "rep"), ["a", "b"]), made)
    on = (source["a"] == asked["a"]) & (source["b"] == asked["b"]) & source["id"].eqNullSafe(asked["rep"])
    met = source.join(asked.hint("shuffle_hash"), on).select(source["a"], source["b"], "text", "r")
    met = met.select("a", "b", "r", _cut()("text", F.col("r.place")).alias("around"))
    cut = met.select("a", "b", F.explode(F.arrays_zip("r", "around")).alias("x"))
    rows = cut.select("a", "b", "x.r.*", "x.around").withColumn("left", F.least(F.col("place"), F.lit(REACH)))
    rows = rows.withColumn("lo", -F.col("left")).withColumn("hi", hi.cast("int")).withColumnRenamed("core", "key")
    # a row that repeats id and text comes twice, but only as company for others: its spans occur again and ask for nothing
    rows = write_and_read(rows, made)
    large = rows.filter(F.col("spans") > largest).select(*ROW, F.lit(-REACH).alias("from"), F.lit(0).alias("to"))
    more, settled = _split_large(large, largest, made)
    small = rows.filter(F.col("spans") <= largest).select(ROW)
    small = small if more is None else small.union(more)
    sorted_ = small.repartition("key").sortWithinPartitions("key")
    ranges = whole.union(sorted_.mapInPandas(_refine, "a bigint, b bigint, start bigint, end bigint"))
    ranges = ranges if settled is None else ranges.union(settled)
    per = ranges.groupBy("a", "b").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
    out = write_and_read(texts.join(per, ["a", "b"], "left").select("a", "b", "copies", "ranges"))
    remove_dirs(spark, made)
    return out


def _keep():
    @F.pandas_udf("n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, copies, ranges in batches:
            out = []
            for t, n, found in zip(texts, copies, ranges):
                text = t.encode()
                if n > 1 and len(text) >= LENGTH:
                    out.append((len(text), len(text), 1, b""))
                    continue
                kept, at, removed, spans = [], 0, 0, 0
                end = -1
                for r in sorted((r["start"], r["end"]) for r in found) if found is not None else ():
                    if r[0] > end:
                        kept.append(text[at : r[0]])
                        spans += 1
                        removed -= r[0]
                        end = r[1]
                        removed += end
                    elif r[1] > end:
                        removed += r[1] - end
                        end = r[1]
                    at = end
                kept.append(text[at:])
                out.append((len(text), removed, spans, b"".join(kept)))
            yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    return run


def without_repeats(docs: DataFrame, largest: int = LARGEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the remaining bytes)."""
    found = repeats(docs, largest, id_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"), *text_key(text))
    met = source.join(found.hint("shuffle_hash"), ["a", "b"])
    return met.select(F.col("id").alias(id_col), _keep()("text", "copies", "ranges").alias("k")).select(id_col, "k.*")
