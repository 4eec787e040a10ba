"""Language-model scoring with a hierarchical Pitman-Yor model.

Tokens are words (A-Z lower-cased, split at blanks) and one end per text. There are three levels of restaurants.

Contexts: every training token has a restaurant for the tokens that follow it (the end token has one for first words). All of
them share the word restaurant as parent: its customers are their tables.

Words: one restaurant of all words. The dish of a new table is drawn from a spelling model: byte contexts of up to three bytes of
the word, each with a restaurant whose new tables are customers of the context one byte shorter, which several contexts share,
down to uniform bytes. So any word has a probability, after any other.

Seating is sampled by Gibbs sweeps. A sweep draws the number of tables of each dish from its conditional given all other seats
(exactly up to `EXACT` customers; beyond, the restaurant is continued in steps of a few per cent of its customers). All (context,
word) pairs are counted by Spark and stay a written table, as do words; rows meet seats of their context and the probability of
their word in joins and are seated in parallel. A pair seen once always has one table, so sweeps only touch the others. Each row's
uniform is a hash of the row and the sweep, so a lost task draws the same again. The tables of the word restaurant are the
spelling model's customers: byte n-gram counts are summed by Spark, contexts with less than one part in `MOST_CONTEXTS` of all
customers share their parent's restaurant, which bounds the spelling model whatever the corpus, and the bounded rest is swept in
numpy. Predictive probabilities are averaged over the last `SAMPLES` sweeps.

For scoring, pairs whose count is over a cutoff (`FREQUENT` pairs at most) go to every task. The pairs of each document below it
meet the scored pairs in a join by a 64-bit hash; no token is left out.

Null and empty texts are one end token. Rows with a null id are held out of training; repeated rows keep their own result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abyssal.functions.common import remove_dirs, shared_dir, write_and_read
from abyssal.llm.batches import bound_batches

EXACT = 64
SWEEPS, SAMPLES = 4, 3
SAMPLED = [f"p{i}" for i in range(SAMPLES)]
STRENGTH = 10.0
MOST_CONTEXTS = 20_000
FREQUENT = 400_000
HEAVY = 100_000  # words and contexts that meet their pairs by broadcast
SLICES = 4  # of the pairs, scored one after the other so that their shuffles do not add up
CHUNK = 100_000  # words or pairs that are seated at once
HELD = 300_000  # words that a counting or scoring task holds
EDGE = 256  # the mark before a word and the symbol after it
SYMBOLS = 257


def words_of(text: str | None) -> list[bytes]:
    """The text's tokens; the end is the empty word."""
    words = (text or "").encode().lower().split()
    words.append(b"")
    return words


def word_hash(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words)).view(np.int64)


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One key of two word hashes; `_pair` is the same in Spark."""
    u = before.view(np.uint64)
    return ((u << np.uint64(1)) | (u >> np.uint64(63))).view(np.int64) ^ word


def _pair() -> Column:
    u = F.col("before")
    return F.shiftleft(u, 1).bitwiseOR(F.shiftrightunsigned(u, 63)).bitwiseXOR(F.col("hash"))


def uniform(keys: np.ndarray, sweep: int) -> np.ndarray:
    """A number in (0, 1) for each key, the same whenever asked."""
    with np.errstate(over="ignore"):
        x = keys.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (sweep + 1)) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


@lru_cache(8)
def stirling(discount: float) -> np.ndarray:
    """Logs of the generalised Stirling numbers: ways to seat c customers at t tables."""
    s = np.full((EXACT + 1, EXACT + 2), -np.inf)
    s[1, 1] = 0.0
    t = np.arange(1, EXACT + 1)
    for c in range(1, EXACT):
        with np.errstate(divide="ignore"):
            stay = s[c, 1:-1] + np.log(np.maximum(c - t * discount, 0))
        s[c + 1, 1:-1] = np.logaddexp(s[c, :-2], stay)
    return s[:, 1:-1]


def draw_tables(c: np.ndarray, log_base: np.ndarray, tables: np.ndarray, discount: float, strength: float, u: np.ndarray) -> np.ndarray:
    """Tables of each dish: ``c`` customers, log probability of the dish in the parent, the restaurant's tables, a uniform."""
    s = stirling(discount)
    steps = np.arange(EXACT)
    out = np.ones(len(c), np.int64)
    capped = np.minimum(c, EXACT)
    for n in np.unique(capped[capped > 1]):
        for rows in np.array_split(np.flatnonzero(capped == n), max(1, int((capped == n).sum()) * n // 500_000)):
            rise = np.log(strength + discount * (tables[rows, None] + steps[:n])).cumsum(axis=1)
            logp = s[n, :n] + rise + log_base[rows, None] * (steps[:n] + 1)
            p = np.exp(logp - logp.max(axis=1, keepdims=True)).cumsum(axis=1)
            out[rows] = 1 + (p < u[rows, None] * p[:, -1:]).sum(axis=1)
    rows = np.flatnonzero(c > EXACT)
    at = np.full(len(rows), EXACT)
    sweep = 0
    while len(rows):
        step = np.minimum(np.maximum(at // 32, 1), c[rows] - at)
        new = (strength + discount * (tables[rows] + out[rows])) * np.exp(log_base[rows])
        expected = step * new / (at - discount * out[rows] + new)
        sweep += 1
        out[rows] = np.minimum(out[rows] + np.floor(expected + uniform((u[rows] * 2**53).astype(np.int64), sweep)).astype(np.int64), at + step)
        at = at + step
        more = at < c[rows]
        rows, at = rows[more], at[more]
    return out


@dataclass
class Restaurants:
    """One level of contexts: (context, symbol) codes in order with customers; seats and predictive probabilities once swept."""

    codes: np.ndarray
    customers: np.ndarray
    tables: np.ndarray = field(default=None)
    log_p: np.ndarray = field(default=None)
    contexts: np.ndarray = field(default=None)
    log_back: np.ndarray = field(default=None)  # per context: weight of the parent

    def __post_init__(self):
        self.contexts, self.which = np.unique(self.codes >> 9, return_inverse=True)
        self.total = np.bincount(self.which, self.customers, len(self.contexts))


def find(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the wanted values, and which of them are there."""
    if not len(sorted_):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return at, sorted_[at] == wanted


def summed(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, which = np.unique(codes, return_inverse=True)
    return keys, np.bincount(which, weights, len(keys))


class Spelling:
    """Restaurants of byte contexts: ``levels[k]`` has contexts of k bytes. Codes hold nine bits for each byte, the symbol last."""

    discount, strength = 0.5, 1.0

    def __init__(self, direct: list[tuple[np.ndarray, np.ndarray]], seed: int, sweeps: int = 4):
        """``direct[k]``: codes and customers that sit down at level k themselves, from the deepest contexts that are kept."""
        rng = np.random.default_rng(seed)
        self.levels: list[Restaurants | None] = [None] * len(direct)
        for sweep in range(sweeps):
            codes, sent = np.zeros(0, np.int64), np.zeros(0)
            old, self.levels = self.levels, list(self.levels)
            for k in range(len(direct) - 1, -1, -1):
                level = Restaurants(*summed(np.concatenate((direct[k][0], codes)), np.concatenate((direct[k][1], sent))))
                base = self._parent(old, k, level.codes) if sweep else np.full(len(level.codes), -np.log(SYMBOLS))
                seats = np.bincount(old[k].which, old[k].tables, len(old[k].contexts)) if sweep else np.zeros(0)
                at, there = find(old[k].contexts, level.contexts) if sweep else (None, None)
                open_ = np.where(there, seats[at], 0.0) if sweep else np.ones(len(level.contexts))
                level.tables = draw_tables(level.customers.astype(np.int64), base, open_[level.which], self.discount, self.strength, rng.random(len(level.codes)))
                self.levels[k] = level
                codes, sent = level.codes & ((1 << 9 * k) - 1), level.tables.astype(np.float64)
            for k in range(len(direct)):
                self._predict(k)

    def _parent(self, levels: list[Restaurants], k: int, codes: np.ndarray) -> np.ndarray:
        return self._log_p(levels, k - 1, codes & ((1 << 9 * k) - 1)) if k else np.full(len(codes), -np.log(SYMBOLS))

    def _predict(self, k: int) -> None:
        level = self.levels[k]
        seats = np.bincount(level.which, level.tables, len(level.contexts))
        back = (self.strength + self.discount * seats) / (self.strength + level.total)
        own = (level.customers - self.discount * level.tables) / (self.strength + level.total)[level.which]
        level.log_p = np.log(own + back[level.which] * np.exp(self._parent(self.levels, k, level.codes)))
        level.log_back = np.log(back)

    def _log_p(self, levels: list[Restaurants], k: int, codes: np.ndarray) -> np.ndarray:
        """Log probability of the symbol after the context, from the deepest restaurant that there is."""
        out = np.zeros(len(codes))
        todo = np.arange(len(codes))
        for depth in range(k, -1, -1):
            level, part = levels[depth], codes[todo] & ((1 << 9 * (depth + 1)) - 1)
            at, seen = find(level.codes, part)
            out[todo[seen]] += level.log_p[at[seen]]
            todo, part = todo[~seen], part[~seen]
            at, there = find(level.contexts, part >> 9)
            out[todo[there]] += level.log_back[at[there]]
        out[todo] -= np.log(SYMBOLS)
        return out

    def log_p_words(self, words: list[bytes]) -> np.ndarray:
        """Natural log probability of each word, its end included."""
        codes, sizes = grams(words)
        if not len(words):
            return np.zeros(0)
        distinct, which = np.unique(codes, return_inverse=True)
        each = self._log_p(self.levels, len(self.levels) - 1, distinct)[which]
        return np.add.reduceat(each, np.concatenate(([0], np.cumsum(sizes)[:-1])))


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every word and its end: three bytes before it and itself, as one code; the number of codes of each word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    symbol = np.frombuffer(b"".join(w + b"\0" for w in words), np.uint8).astype(np.int64)
    ends = np.cumsum(sizes)
    symbol[ends - 1] = EDGE
    place = np.arange(len(symbol)) - np.repeat(ends - sizes, sizes)
    codes = symbol.copy()
    for back in (1, 2, 3):
        before = np.full(len(symbol), EDGE, np.int64)
        before[back:] = symbol[:-back] if len(symbol) > back else symbol[:0]
        before[place < back] = EDGE
        codes |= before << (9 * back)
    return codes, sizes


@dataclass
class Sample:
    """The state after a sweep: number of tables in the word restaurant, spelling model."""

    tables: float
    spelling: Spelling


class Contexts:
    """The restaurants of a small set of contexts as a dense matrix over a uniform base, for checks; ``log_p[context, dish]`` in log10."""

    discount, strength = 0.5, 10.0

    def __init__(self, counts: np.ndarray, seed: int = 5):
        rng, size = np.random.default_rng(seed), len(counts)
        at = np.nonzero(counts)
        c, total = counts[at].astype(np.int64), counts.sum(axis=1)
        parent, seats, top_seats = np.full(size, 1.0 / size), np.zeros(size), 0.0
        mean = np.zeros((size, size))
        for sweep in range(SWEEPS):
            t = draw_tables(c, np.log(parent[at[1]]), seats[at[0]], self.discount, self.strength, rng.random(len(c)))
            seats = np.bincount(at[0], t, size)
            customers = np.bincount(at[1], t, size).astype(np.int64)
            there = np.flatnonzero(customers)
            top = np.zeros(size)
            top[there] = draw_tables(customers[there], np.full(len(there), -np.log(size)), np.full(len(there), top_seats), self.discount, self.strength, rng.random(len(there)))
            top_seats = top.sum()
            parent = (customers - self.discount * top + (self.strength + self.discount * top_seats) / size) / (self.strength + customers.sum())
            if sweep >= SWEEPS - SAMPLES:
                own = np.zeros((size, size))
                own[at] = c - self.discount * t
                mean += (own + (self.strength + self.discount * seats)[:, None] * parent) / (self.strength + total)[:, None]
        self.log_p = np.log10(mean / SAMPLES)


def contexts_of(dish: np.ndarray, none: int) -> np.ndarray:
    """For every token of a text the last frequent token before it, or ``none``."""
    place = np.where(dish < none, np.arange(1, len(dish) + 1), 0)
    last = np.concatenate(([0], np.maximum.accumulate(place)[:-1])) if len(dish) else place
    return np.where(last > 0, dish[last - 1], none)


@dataclass
class WordModel:
    """The word restaurant as every task needs it: totals, discount and samples."""

    tokens: int
    types: int
    discount: float
    samples: list[Sample]
    others: int = 0  # customers

    def seat(self, words: list[bytes], c: np.ndarray, keys: np.ndarray, sample: Sample, sweep: int) -> tuple[np.ndarray, np.ndarray]:
        """Tables of words with ``c`` customers (none without any), and the log probability of their spelling."""
        log_base = sample.spelling.log_p_words(words)
        t = draw_tables(c, log_base, np.full(len(c), sample.tables), self.discount, STRENGTH, uniform(keys, sweep))
        return np.where(c > 0, t, 0), log_base

    def seen(self, words: list[bytes], c: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """log10 of the averaged predictive probability of words with ``c`` customers."""
        total = np.zeros(len(words))
        for i, s in enumerate(self.samples):
            t, log_base = self.seat(words, c, keys, s, i)
            total += c - self.discount * t + (STRENGTH + self.discount * s.tables) * np.exp(log_base)
        return np.log10(total / (len(self.samples) * (STRENGTH + self.others)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(True))


def count_words(texts: DataFrame) -> DataFrame:
    """(word, hash, c) over columns text and held_out; c counts training tokens only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[bytes] = Counter()
        for pdf in batches:
            for text, held in zip(pdf["text"], pdf["held_out"]):
                counts.update(dict.fromkeys(words_of(text), 0) if held else words_of(text))
                if len(counts) > HELD:
                    yield pd.DataFrame({"word": list(counts), "c": list(counts.values())})
                    counts.clear()
        yield pd.DataFrame({"word": list(counts), "c": list(counts.values())}, columns=["word", "c"])

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _chunks(batches):
            yield pdf.assign(hash=word_hash(pdf["word"].tolist()))

    counted = texts.mapInPandas(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))
    return counted.mapInPandas(keyed, "word binary, c bigint, hash bigint")


class _Slots:
    """Numbers and hashes of the words a task has met lately; the end is number 0."""

    def __init__(self):
        self.slot: dict[bytes, int] = {b"": 0}
        self.hash = word_hash([b""])

    def numbers(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.slot) > HELD:
            self.__init__()
        new = [w for w in set().union(*texts) if w not in self.slot]
        self.slot.update(zip(new, range(len(self.slot), len(self.slot) + len(new))))
        self.hash = np.concatenate((self.hash, word_hash(new)))
        return [np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words)) for words in texts]


def before(at: np.ndarray) -> np.ndarray:
    """For every token of a text the one before it; the end before the first."""
    return np.concatenate((np.zeros(1, np.int64), at[:-1]))


def slice_of(pair: Column) -> Column:
    return F.pmod(pair, F.lit(SLICES)).cast("int")


def count_pairs(texts: DataFrame) -> DataFrame:
    """(before, hash, c, n, slice) over columns text and held_out: every token after every other, in training and in all."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots = _Slots()
        for pdf in batches:
            at = slots.numbers([words_of(t) for t in pdf["text"]])
            if not at:
                continue
            train = np.repeat(~pdf["held_out"].to_numpy(bool), [len(x) for x in at])
            codes, which = np.unique(np.concatenate([before(x) for x in at]) << 32 | np.concatenate(at), return_inverse=True)
            c, n = np.bincount(which, train, len(codes)), np.bincount(which, minlength=len(codes))
            yield pd.DataFrame({"before": slots.hash[codes >> 32], "hash": slots.hash[codes & 0xFFFFFFFF], "c": c.astype(np.int64), "n": n})

    found = texts.mapInPandas(run, "before bigint, hash bigint, c bigint, n bigint")
    return found.groupBy("before", "hash").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).withColumn("slice", slice_of(_pair()))


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of several batches together: they are short, and numpy works on many at once."""
    held, size = [], 0
    for pdf in batches:
        held.append(pdf)
        size += len(pdf)
        if size >= CHUNK:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if size:
        yield pd.concat(held, ignore_index=True)


def seat_words(words: DataFrame, model: WordModel, state: Sample, number: int) -> DataFrame:
    """(word, hash, c, n, p0 .., t, log_base) of words with ``n`` customers; what earlier samples gave stays."""
    columns = ["word", "hash", "c", "n", *[x for x in words.columns if x in SAMPLED]]
    schema = ", ".join(f"{x} {t}" for x, t in words.select(columns).dtypes) + ", t bigint, log_base double"
    shared = words.sparkSession.sparkContext.broadcast((model, state))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, state = shared.value
        for pdf in _chunks(batches):
            t, log_base = model.seat(pdf["word"].tolist(), pdf["n"].to_numpy(), pdf["hash"].to_numpy(), state, number)
            yield pdf.assign(t=t, log_base=log_base)

    return words.select(columns).mapInPandas(run, schema)


def fit_spelling(words: DataFrame, number: int) -> Sample:
    """The spelling model of the word restaurant's tables (word, t), and their number."""
    spark = words.sparkSession

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _chunks(batches):
            codes, sizes = grams(pdf["word"].tolist())
            keys, n = summed(codes, np.repeat(pdf["t"].to_numpy(), sizes))
            yield pd.DataFrame({"code": keys, "n": n.astype(np.int64)})

    made: list[str] = []
    found = write_and_read(words.filter("t > 0").select("word", "t").mapInPandas(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")), made)
    # each word's tables show in the counts of its end
    tables, total = found.agg(F.sum(F.when(F.col("code").bitwiseAND(511) == EDGE, F.col("n"))), F.sum("n")).first()
    context = F.shiftright("code", 9)
    kept = found.groupBy(context.alias("context")).agg(F.sum("n").alias("size")).filter(F.col("size") >= (total or 0) / MOST_CONTEXTS).select("context")
    kept = write_and_read(kept, made)  # at most `MOST_CONTEXTS` rows
    deep = found.join(F.broadcast(kept), context == F.col("context"), "left_semi")
    rest = found.join(F.broadcast(kept), context == F.col("context"), "left_anti")
    direct = []
    for k in range(3):
        empty = (np.zeros(0, np.int64), np.zeros(0))
        direct.append(empty if k < 2 else _pairs(rest.groupBy(F.col("code").bitwiseAND((1 << 27) - 1).alias("code")).agg(F.sum("n").alias("n"))))
    direct.append(_pairs(deep))
    remove_dirs(spark, made)
    return Sample(float(tables or 0), Spelling(direct, number))


def _pairs(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of bounded size: the symbols of the kept contexts, or of two-byte contexts."""
    pdf = counts.select("code", "n").toPandas().sort_values("code")
    return pdf["code"].to_numpy(np.int64), pdf["n"].to_numpy(np.float64)


def seat_pairs(pairs: DataFrame, discount: float, number: int) -> DataFrame:
    """Reseats (before, hash, c, n) rows given ``log_p`` of the word in the parent and ``seats``, the context's other tables; adds ``t``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _chunks(batches):
            u = uniform(pair_hash(pdf["before"].to_numpy(), pdf["hash"].to_numpy()), number)
            t = draw_tables(pdf["c"].to_numpy(), pdf["log_p"].to_numpy(), pdf["seats"].to_numpy(), discount, STRENGTH, u)
            yield pdf.drop(columns=["log_p", "seats"]).assign(t=t)

    return pairs.mapInPandas(run, "before bigint, hash bigint, c bigint, n bigint, sum bigint, t bigint")


def discount_of(rows: DataFrame) -> float:
    """From the rows with one and two customers."""
    once, twice = rows.agg(F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    return float(np.clip((once + 1) / (once + 2 * twice + 2), 0.1, 0.9))


def _met(rows: DataFrame, table: DataFrame, heavy: DataFrame, key: str) -> tuple[tuple[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]:
    """Rows whose key is in ``heavy`` with the part of ``table`` they meet by broadcast, so they make no large group; the others and theirs."""
    heavy = F.broadcast(heavy)
    return (rows.join(heavy, key, "left_semi"), F.broadcast(table.join(heavy, key, "left_semi"))), (rows.join(heavy, key, "left_anti"), table.join(heavy, key, "left_anti"))


@dataclass
class Fitted:
    """What scores any pair: `model`, the contexts' discount, and the written tables. ``words`` has ``p{i}``, ``contexts`` has
    ``total`` and ``seats{i}`` for each sample i; ``pairs`` has ``sum``, its tables over all samples."""

    model: WordModel
    discount: float
    words: DataFrame
    contexts: DataFrame
    pairs: DataFrame
    heavy_words: DataFrame  # keys of the largest
    heavy_contexts: DataFrame

    def scored(self, pairs: DataFrame) -> DataFrame:
        """(pair, c_word, log_p): log10 of the averaged predictive probability of every row of ``pairs``."""
        words, both = self.words.withColumnRenamed("c", "c_word"), None
        for rows, of_words in _met(pairs, words, self.heavy_words, "hash"):
            for some, of_contexts in _met(rows, self.contexts, self.heavy_contexts, "before"):
                met = some.join(of_words, "hash", "left").join(of_contexts, "before", "left")
                both = met if both is None else both.unionByName(met)
        total, own = F.coalesce("total", F.lit(0)), F.lit(SAMPLES) * F.col("c") - F.lit(self.discount) * F.col("sum")
        for i in range(SAMPLES):
            own = own + (F.lit(STRENGTH) + F.lit(self.discount) * F.coalesce(f"seats{i}", F.lit(0))) * F.col(f"p{i}")
        return both.select(_pair().alias("pair"), "c_word", F.log10(own / (F.lit(SAMPLES) * (F.lit(STRENGTH) + total))).alias("log_p"))


def fit(words: DataFrame, pairs: DataFrame, made: list[str]) -> Fitted:
    """The model of (written) counts of words and pairs."""
    spark = words.sparkSession
    tokens, types = (x or 0 for x in words.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first())
    model = WordModel(tokens, types, discount_of(words), [])
    discount = discount_of(pairs)
    # a pair seen once has one table whatever the sweep
    once = F.count_if(F.col("c") == 1)
    old: list[str] = []  # tables of the sweep before
    kept: list[str] = []  # tables of all sweeps
    contexts = write_and_read(pairs.filter("c > 0").groupBy("before").agg(F.sum("c").alias("total"), once.alias("fixed"), F.count("*").alias("seats")), old)
    fixed = write_and_read(pairs.filter("c > 0").groupBy("hash").agg(once.alias("fixed"), F.count("*").alias("n")), kept)
    seated = pairs.filter("c > 1").select("before", "hash", "c", "n", F.lit(0).cast("bigint").alias("sum"), F.lit(1).cast("bigint").alias("t"))
    seated = write_and_read(seated, old)
    customers, state = fixed.select("hash", "n"), fit_spelling(words.withColumn("t", (F.col("c") > 0).cast("bigint")), 0)
    for number in range(1, SWEEPS + 1):
        now: list[str] = []
        placed = words.join(customers, "hash", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        placed = write_and_read(seat_words(placed, model, state, number), now)
        all_n, tables = (x or 0 for x in placed.agg(F.sum("n"), F.sum("t")).first())
        model.others = all_n
        p = (F.col("n") - model.discount * F.col("t") + F.exp("log_base") * (STRENGTH + model.discount * tables)) / (STRENGTH + all_n)
        words, sample = placed.select("word", "hash", "c", *[x for x in SAMPLED if x in placed.columns]), number - (SWEEPS - SAMPLES) - 1
        if sample >= 0:
            words = placed.select(*words.columns, p.alias(f"p{sample}"))
            contexts = contexts.withColumn(f"seats{sample}", F.col("seats"))
            seated = seated.withColumn("sum", F.col("sum") + F.col("t"))
        if number == SWEEPS:
            break
        state = fit_spelling(placed, number)
        met = seated.join(placed.select("hash", F.log(p).alias("log_p")), "hash").join(contexts.select("before", "seats"), "before")
        others = F.col("seats") - F.col("t")
        seated = write_and_read(seat_pairs(met.select("before", "hash", "c", "n", "sum", "log_p", others.alias("seats")), discount, number), now)
        tables = seated.groupBy("hash").agg(F.sum("t").alias("t"))
        customers = fixed.join(tables, "hash", "left").select("hash", (F.col("fixed") + F.coalesce("t", F.lit(0))).alias("n"))
        tables = seated.groupBy("before").agg(F.sum("t").alias("t"))
        contexts = contexts.drop("seats").join(tables, "before", "left").withColumn("seats", F.col("fixed") + F.coalesce("t", F.lit(0))).drop("t")
        contexts = write_and_read(contexts, now)
        customers = write_and_read(customers, now)
        remove_dirs(spark, old)
        old = now
    words, contexts = write_and_read(words.drop("word"), made), write_and_read(contexts.drop("fixed", "seats"), made)
    seated = write_and_read(seated.drop("t"), made)
    remove_dirs(spark, old + now + kept)
    rest = pairs.filter("c < 2").withColumn("sum", F.lit(SAMPLES) * F.col("c"))
    heavy_words = write_and_read(words.orderBy(F.desc("c"), "hash").limit(HEAVY).select("hash"), made)
    heavy_contexts = write_and_read(contexts.orderBy(F.desc("total"), "before").limit(HEAVY).select("before"), made)
    both = rest.select("before", "hash", "c", "n", "sum", "slice").unionByName(seated.withColumn("slice", slice_of(_pair())))
    return Fitted(model, discount, words, contexts, both, heavy_words, heavy_contexts)


@dataclass
class Frequent:
    """Of the frequent pairs: hashes in order, count of the word, log10 of the probability."""

    pairs: np.ndarray
    known: np.ndarray
    base: np.ndarray
    log_p: np.ndarray


def _scorer(frequent: Frequent, spark: SparkSession):
    """Column function of a text: what its frequent pairs give, and hash and count of each other pair, by slice."""
    shared = spark.sparkContext.broadcast(frequent)
    sums = ["n", "n_known", "base", "score"]
    tails = [f"{x}{i}" for i in range(SLICES) for x in ("pairs", "counts")]

    @F.pandas_udf("n bigint, n_known bigint, base double, score double, " + ", ".join(f"{x} array<bigint>" for x in tails))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        f, slots = shared.value, _Slots()
        for series in batches:
            out = []
            for a in range(0, len(series), 500):
                for at in slots.numbers([words_of(t) for t in series.iloc[a : a + 500]]):
                    codes, counts = np.unique(pair_hash(slots.hash[before(at)], slots.hash[at]), return_counts=True)
                    place, there = find(f.pairs, codes)
                    front, n, codes, counts = place[there], counts[there], codes[~there], counts[~there]
                    parts = [x for i in range(SLICES) for x in (codes[codes % SLICES == i], counts[codes % SLICES == i])]
                    out.append((len(at), int(n @ f.known[front]), float(n @ f.base[front]), float(n @ f.log_p[front]), *parts))
            yield pd.DataFrame(out, columns=sums + tails)

    return run


def _write_slices(pairs: DataFrame, made: list[str]) -> DataFrame:
    """As `write_and_read`, a folder for each slice, so scoring a slice reads no other."""
    spark, path = pairs.sparkSession, shared_dir(pairs.sparkSession)
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(SLICES))  # no sort by slice before
    pairs.write.partitionBy("slice").parquet(path)
    made.append(path)
    return spark.read.schema(pairs.schema).parquet(path)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, and perplexity (per token)."""
    spark, made = docs.sparkSession, []
    bound_batches(spark)
    # every shuffle here feeds one write; pairs outnumber all else, so their files go when it is done
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out(F.col(id_col)).alias("held_out"))
    counted: list[str] = []
    words = write_and_read(count_words(source.select("text", "held_out")), counted)
    pairs = _write_slices(count_pairs(source.select("text", "held_out")), made)
    fitted = fit(words, pairs, made)
    remove_dirs(spark, counted)
    model = fitted.model
    # the smallest count that at most ``frequent`` pairs reach
    sizes = sorted(((r["n"], r["count"]) for r in pairs.groupBy("n").count().collect()), reverse=True)
    cutoff, size = 1 << 62, 0
    for n, count in sizes:
        size += count
        if size > frequent:
            break
        cutoff = n
    ratio = 1.0 / (model.tokens + 0.1 * (model.types + 1))
    top = fitted.scored(fitted.pairs.filter(F.col("n") >= cutoff)).toPandas().sort_values("pair")
    c = top["c_word"].to_numpy(np.int64)
    known = Frequent(top["pair"].to_numpy(np.int64), (c > 0).astype(np.int64), np.log10((c + 0.1) * ratio), top["log_p"].to_numpy(np.float64))
    scored = source.select("doc_id", "held_out", _scorer(known, spark)("text").alias("s")).select("doc_id", "held_out", "s.*")
    # the row number is written with its row, and stays
    parts = write_and_read(scored.withColumn("key", F.monotonically_increasing_id()))
    rare = fitted.pairs.filter(F.col("n") < cutoff)
    c, columns = F.col("c_word"), ["key", "n_known", "base", "score"]
    per = parts.select(columns)
    for i in range(SLICES):
        each = parts.select("key", F.explode(F.arrays_zip(F.col(f"pairs{i}").alias("pair"), F.col(f"counts{i}").alias("n"))).alias("t"))
        met = each.select("key", "t.pair", "t.n").join(fitted.scored(rare.filter(F.col("slice") == i)), "pair").select(
            "key", F.when(c > 0, F.col("n")).otherwise(0).alias("n_known"), (F.col("n") * F.log10((c + 0.1) * F.lit(ratio))).alias("base"), (F.col("n") * F.col("log_p")).alias("score")
        )
        per = per.unionByName(write_and_read(met.groupBy("key").agg(*[F.sum(x).alias(x) for x in columns[1:]]), made))
    per = write_and_read(per.groupBy("key").agg(*[F.sum(x).alias(x) for x in columns[1:]]))
    remove_dirs(spark, made)
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n"))
    return parts.select("key", "doc_id", "held_out", "n").join(per, "key").select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"), "score", perplexity.alias("perplexity"),
    )
