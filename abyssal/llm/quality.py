"""Quality classifier: a byte-level convolutional network in numpy.

Every byte gets a learned vector. Filters see windows of `WIDTH` bytes, one every `STRIDE` bytes, so windows overlap and cover
the whole text. Filter outputs are max-pooled over overlapping chunks of two halves of `HALF` windows; over the chunks both the
largest and the smallest chunk value of each filter are pooled (one says that a pattern occurs, the other that it is missing
somewhere, as in text that repeats itself). A small dense layer turns them into one probability.

Null and empty texts are scored too: they are padding only. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.llm.batches import bound_batches, return_memory

WIDTH, STRIDE, HALF = 8, 2, 64
DIM, FILTERS, HIDDEN = 8, 32, 16
BLOCK = 1 << 19  # bytes of texts that are scored at once
STEP = 4096  # windows that go through the filters at once, few enough for the processor's cache


@dataclass(frozen=True)
class TrainingBounds:
    """The sample that the network is fitted on: its size is bounded whatever the corpus."""

    rows: int = 3000
    max_bytes: int = 60_000  # longer texts are scored, but not fitted on
    epochs: int = 8
    batch: int = 32
    seed: int = 7


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, each followed by zero bytes (`WIDTH` at least) up to a whole half chunk; the first half of each."""
    unit = STRIDE * HALF
    halves = [-(-(len(t) + WIDTH) // unit) for t in texts]
    data = np.frombuffer(b"".join(t.ljust(n * unit, b"\0") for t, n in zip(texts, halves)) + b"\0" * WIDTH, np.uint8)
    return data, np.concatenate(([0], np.cumsum(halves)))


class ByteNet:
    """Parameters, forward pass and training."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.p = {
            "embed": rng.normal(0, 0.5, (256, DIM)).astype(np.float32),
            "conv": rng.normal(0, 1 / np.sqrt(WIDTH * DIM), (WIDTH * DIM, FILTERS)).astype(np.float32),
            "w1": rng.normal(0, 1 / np.sqrt(2 * FILTERS), (2 * FILTERS, HIDDEN)).astype(np.float32),
            "b1": np.zeros(HIDDEN, np.float32),
            "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN).astype(np.float32),
            "b2": np.zeros(1, np.float32),
        }

    def windows(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.p["embed"][data[at[:, None] * STRIDE + np.arange(WIDTH)]].reshape(len(at), WIDTH * DIM)

    def filters(self, data: np.ndarray, n: int) -> np.ndarray:
        """Outputs of all filters at the first ``n`` windows."""
        out = np.empty((n, FILTERS), np.float32)
        for a in range(0, n, STEP):
            b = min(n, a + STEP)
            x = self.p["embed"].take(data[a * STRIDE : (b - 1) * STRIDE + WIDTH], axis=0)
            view = np.lib.stride_tricks.as_strided(x, (b - a, WIDTH * DIM), (STRIDE * DIM * 4, 4))
            np.matmul(np.ascontiguousarray(view), self.p["conv"], out=out[a:b])
        return out

    def pooled(self, data: np.ndarray, first: np.ndarray):
        """Per text: largest chunk value and smallest chunk value of each filter, with what training needs to find them again."""
        out = self.filters(data, first[-1] * HALF)
        half = self.halves(out, first[1:] - 1)
        features, low = self.features(half, first)
        return features, (out, half, low)

    @staticmethod
    def halves(out: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Largest output of each filter in every half chunk; ``last``: the last halves of texts."""
        out = out.reshape(-1, HALF, FILTERS)
        # the last windows hold padding only and reach into the next text
        out[last, 1 - WIDTH // STRIDE :] = -np.inf
        return out.max(axis=1)

    @staticmethod
    def features(half: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        last, low = first[1:] - 1, half.copy()
        inner = np.ones(len(half), bool)
        inner[last] = False  # the last half of a text has no right neighbour
        at = np.flatnonzero(inner)
        low[at] = np.maximum(half[at], half[at + 1])
        low[last[np.diff(first) > 1]] = np.inf
        return np.hstack((np.maximum.reduceat(half, first[:-1], axis=0), np.minimum.reduceat(low, first[:-1], axis=0))), low

    def head(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.maximum(features @ self.p["w1"] + self.p["b1"], 0)
        return hidden, 1 / (1 + np.exp(-np.clip(hidden @ self.p["w2"] + self.p["b2"], -30, 30)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 for each text; memory is bounded by a block of texts or by the longest one."""
        scores, a = np.empty(len(texts)), 0
        while a < len(texts):
            b, size = a, 0
            while b < len(texts) and (b == a or size + len(texts[b]) < BLOCK):
                size += len(texts[b])
                b += 1
            scores[a:b] = self.head(self.pooled_long(texts[a]) if size > 4 * BLOCK else self.pooled(*layout(texts[a:b]))[0])[1]
            a = b
        return scores

    def pooled_long(self, text: bytes) -> np.ndarray:
        """The same features of one very long text, part by part, so that outputs of all its windows are never held at once."""
        data, first = layout([text])
        found, part = [], BLOCK // (HALF * STRIDE)
        for a in range(0, first[-1], part):
            b = min(first[-1], a + part)
            out = self.filters(data[a * HALF * STRIDE :], (b - a) * HALF)
            found.append(self.halves(out, np.array([b - a - 1] if b == first[-1] else [], np.int64)))
        return self.features(np.concatenate(found), first)[0]

    def gradients(self, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
        data, first = layout(texts)
        features, (out, half, low) = self.pooled(data, first)
        hidden, prob = self.head(features)
        delta = (prob - labels) / len(texts)
        back = np.outer(delta, self.p["w2"]) * (hidden > 0)
        grad = {"w2": hidden.T @ delta, "b2": delta.sum(keepdims=True), "w1": features.T @ back, "b1": back.sum(0)}
        to_features = back @ self.p["w1"].T
        # where the pooled values came from: the half chunk, then the window in it
        n, cols = len(texts), np.arange(FILTERS)
        picks = np.empty((n, 2 * FILTERS), np.int64)
        for i in range(n):
            rows = slice(first[i], first[i + 1])
            picks[i, :FILTERS] = first[i] + half[rows].argmax(0)
            least = first[i] + low[rows].argmin(0)
            right = np.minimum(least + 1, first[i + 1] - 1)
            picks[i, FILTERS:] = np.where(half[right, cols] > half[least, cols], right, least)
        which = np.tile(cols, 2 * n)
        picks = picks.ravel()
        span = picks[:, None] * HALF + np.arange(HALF)
        at = span[np.arange(len(picks)), out[span, which[:, None]].argmax(1)]
        weight = to_features.ravel()
        x = self.windows(data, at)
        conv = np.zeros((FILTERS, WIDTH * DIM), np.float32)
        np.add.at(conv, which, x * weight[:, None])
        grad["conv"] = conv.T
        into = (self.p["conv"].T[which] * weight[:, None]).reshape(-1, DIM)
        embed = np.zeros((256, DIM), np.float32)
        np.add.at(embed, data[at[:, None] * STRIDE + np.arange(WIDTH)].ravel(), into)
        grad["embed"] = embed
        return grad

    def fit(self, texts: list[bytes], labels: np.ndarray, bounds: TrainingBounds) -> ByteNet:
        """Adam over shuffled batches of texts of like length; deterministic for given rows."""
        rng = np.random.default_rng(bounds.seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, bounds.epochs * -(-len(texts) // bounds.batch)
        for _ in range(bounds.epochs):
            order = rng.permutation(len(texts))
            for a in range(0, len(order), bounds.batch):
                rows = order[a : a + bounds.batch]
                grad = self.gradients([texts[i] for i in rows], labels[rows])
                step += 1
                rate = 0.01 * (1 - 0.9 * step / total)
                for k, g in grad.items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        return self


def fit(docs: DataFrame, labels: DataFrame, bounds: TrainingBounds = TrainingBounds()) -> ByteNet:
    """A network fitted on at most ``bounds.rows`` labelled rows (doc_id, quality), picked by a hash of the id.

    An id with several labels or texts counts with the smallest of each. Rows without id, label or text and texts over ``bounds.max_bytes`` are left out of the fit. With no usable row the network
    gives every text about even odds.
    """
    bound_batches(docs.sparkSession)
    ids = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    small = docs.select("doc_id", "text").filter(F.octet_length("text") <= bounds.max_bytes)
    picked = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bounds.rows)
    texts = small.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = texts.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bounds.rows).collect()
    net = ByteNet(bounds.seed)
    if not rows:
        return net
    return net.fit([r["text"].encode() for r in rows], np.array([r["quality"] for r in rows], np.float32), bounds)


def scorer(net: ByteNet):
    """A column function: text to probability of label 1."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for texts in batches:
                yield pd.Series(net.score([t.encode() if isinstance(t, str) else b"" for t in texts]))
        finally:
            return_memory()

    return score


def in_training(doc_id: Column) -> Column:
    """Rows that labels may be learnt from; null ids are held out of training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))
