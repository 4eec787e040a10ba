import math
import random
import zlib
from collections import Counter
from itertools import product
from pathlib import Path

import numpy as np

from abyssal.functions.common import shared_dir
from abyssal.llm import pitman_yor as py


def test_tables_follow_their_conditional():
    """Against the law of table counts summed up from single customers."""
    d, strength, others, base = 0.5, 1.0, 3.0, 0.2
    n, c = 20_000, 5
    weights = {}
    for seats in product((0, 1), repeat=c - 1):  # whether each later customer opens a table
        w, t = (strength + d * others) * base, 1
        for i, new in enumerate(seats, start=1):
            w *= (strength + d * (others + t)) * base if new else i - d * t
            t += new
        weights[t] = weights.get(t, 0) + w
    u = (np.arange(n) + 0.5) / n
    got = Counter(py.draw_tables(np.full(n, c), np.full(n, math.log(base)), np.full(n, others), d, strength, u).tolist())
    for t, w in weights.items():
        assert abs(got[t] / n - w / sum(weights.values())) < 0.001


def test_spelling_sums_to_one():
    words = [b"", b"abc", b"abd", b"ab", "é".encode(), b"zzzzzzzz"]
    codes, sizes = py.grams(words)
    assert sizes.tolist() == [1, 4, 4, 3, 3, 9]
    keys, n = py.summed(codes, np.ones(len(codes)))
    nothing = (np.zeros(0, np.int64), np.zeros(0))
    s = py.Spelling([nothing, nothing, nothing, (keys, n)], 3)
    for context in (keys[0] >> 9, keys[-1] >> 9, 5):
        total = np.exp(s._log_p(s.levels, 3, (np.int64(context) << 9) | np.arange(py.SYMBOLS))).sum()
        assert abs(total - 1) < 1e-9
    assert s.log_p_words([b"abc"])[0] > s.log_p_words([b"xyq"])[0]


def corpus(n=300):
    rng = random.Random(2)
    syllables = ["an", "the", "ing", "er", "on", "ti", "de", "la"]
    rows = [(i, " ".join("".join(rng.choice(syllables) for _ in range(rng.choice([1, 1, 2, 4]))).title() for _ in range(rng.randint(1, 80)))) for i in range(n)]
    return rows + [(900, None), (901, ""), (902, "qqq " * 50), (5, "the the"), (None, "the"), (903, "the " * 20_000)]


def test_scores(spark):
    rows = corpus()
    train = Counter()
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            train.update((t or "").lower().split() + [""])
    total, types = sum(train.values()), len(train)
    got = {}
    for frequent in (10, 100_000):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        out = py.score(docs, frequent=frequent).collect()
        assert len(out) == len(rows)
        got[frequent] = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in out)
        for r in out:
            if r.doc_id in (None, 5):
                continue
            words = (dict(rows)[r.doc_id] or "").lower().split() + [""]
            base = sum(math.log10((train[w] + 0.1) / (total + 0.1 * (types + 1))) for w in words)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(train[w] > 0 for w in words), total)
            assert abs(r.base_score - base) < 1e-6 * abs(base) and r.score < 0
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
    assert got[10] == got[100_000]
    held = [r for r in out if r.held_out and r.doc_id is not None]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert py.score(docs.limit(0)).collect() == []


def test_contexts_sum_to_one():
    counts = np.random.default_rng(1).integers(0, 4, (6, 6)) * np.array([[900], [1], [0], [1], [5], [1]])
    c = py.Contexts(counts.astype(float))
    assert np.allclose((10.0**c.log_p).sum(axis=1), 1)
    assert py.contexts_of(np.array([3, 9, 9, 2, 9]), 9).tolist() == [9, 3, 3, 3, 2]


def test_probabilities_sum_to_one():
    words, c = [b"", b"a", b"ab", b"b"], np.array([4, 9, 2, 1])
    codes, sizes = py.grams(words)
    keys, n = py.summed(codes, np.ones(len(codes)))
    nothing = (np.zeros(0, np.int64), np.zeros(0))
    spelling = py.Spelling([nothing, nothing, nothing, (keys, n)], 1)
    base, keyed = spelling.log_p_words(words), py.word_hash(words)
    t = py.draw_tables(c, base, np.full(4, 4.0), 0.5, py.STRENGTH, py.uniform(keyed, 0))
    model = py.WordModel(16, 4, 0.5, [py.Sample(4.0, spelling)], others=16)
    model.samples[0].tables = 4.0
    seen = 10 ** model.seen(words, c, keyed)
    unseen = np.exp(base) * (py.STRENGTH + 0.5 * 4.0) / (py.STRENGTH + 16)
    # what known words have beside their base parts is what their customers leave after the discounts
    assert abs((seen - unseen).sum() - (16 - 0.5 * t.sum()) / (py.STRENGTH + 16)) < 1e-9


def test_rare_words_are_contexts(spark):
    """Every word has a restaurant of its own, however rare: a pair of rare words that always meet is foreseen."""
    rng = random.Random(4)
    rare = [(f"left{i}", f"right{i}") for i in range(1500)]
    pieces = [f"{a} {b}" for a, b in rare for _ in range(3)]
    rng.shuffle(pieces)
    rows = [(i, " ".join(pieces[i * 10 : i * 10 + 10])) for i in range(450)]
    train = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    seen = Counter(p for _, t in train for p in zip(t.split()[::2], t.split()[1::2]))
    (a, b), (c, d) = [p for p in rare if seen[p] == 3][:2]
    held = [i for i in range(1000, 1100) if not zlib.crc32(str(i).encode()) % 10][:2]
    docs = spark.createDataFrame(rows + [(held[0], f"{a} {b}"), (held[1], f"{a} {d}")], "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r.score for r in py.score(docs, frequent=100).collect()}
    assert got[held[0]] > got[held[1]] + 1


def test_scored_pairs_sum_to_one(spark):
    """After a seen context and after an unseen one, over the words there are and all others (by their spelling)."""
    docs = spark.createDataFrame([(i, "a b a c a b", False) for i in range(5)] + [(9, "z a", True)], "doc_id bigint, text string, held_out boolean")
    words, pairs, made = py.count_words(docs).cache(), py.count_pairs(docs).cache(), []
    counted = {(r["before"], r["hash"]): (r["c"], r["n"]) for r in pairs.collect()}
    key = dict(zip(["", "a", "b", "c", "z"], py.word_hash([b"", b"a", b"b", b"c", b"z"]).tolist()))
    assert counted[key["a"], key["b"]] == (10, 10) and counted[key["z"], key["a"]] == (0, 1) and counted[key["b"], key[""]] == (5, 5)
    fitted = py.fit(words, pairs, made)
    p = {r["hash"]: [r[f"p{i}"] for i in range(py.SAMPLES)] for r in fitted.words.collect()}
    rest = [1 - sum(x[i] for x in p.values()) for i in range(py.SAMPLES)]
    assert all(0 < x < 1 for x in rest)
    grid = spark.createDataFrame([(u, w, *counted.get((u, w), (0, 0))) for u in key.values() for w in key.values()], "before bigint, hash bigint, c bigint, n bigint")
    sums = {(r["before"], r["hash"]): r["sum"] for r in fitted.pairs.collect()}
    rows = [(r["before"], r["hash"], r["c"], r["n"], sums.get((r["before"], r["hash"]), 0)) for r in grid.collect()]
    scored = {r["pair"]: r["log_p"] for r in fitted.scored(spark.createDataFrame(rows, "before bigint, hash bigint, c bigint, n bigint, sum bigint")).collect()}
    contexts = {r["before"]: r for r in fitted.contexts.collect()}
    for name, u in key.items():
        pair = py.pair_hash(np.full(len(key), u), np.array(list(key.values())))
        r = contexts.get(u)
        back = [(py.STRENGTH + fitted.discount * (r[f"seats{i}"] if r else 0)) / (py.STRENGTH + (r["total"] if r else 0)) for i in range(py.SAMPLES)]
        missing = sum(x * y for x, y in zip(back, rest)) / py.SAMPLES
        assert abs(sum(10 ** scored[int(x)] for x in pair) + missing - 1) < 1e-9, name


def test_sweeps_and_samples(spark):
    """Four sweeps, of which the last three are averaged."""
    docs = spark.createDataFrame([(i, "a b a c a b", False) for i in range(5)], "doc_id bigint, text string, held_out boolean")
    fitted = py.fit(py.count_words(docs).cache(), py.count_pairs(docs).cache(), [])
    assert (py.SWEEPS, py.SAMPLES) == (4, 3)
    assert [c for c in fitted.words.columns if c.startswith("p")] == ["p0", "p1", "p2"]
    assert all(3 <= r["sum"] <= 3 * r["c"] for r in fitted.pairs.collect())


def test_fit_leaves_what_scoring_reads(spark):
    """Tables of the sweeps and of earlier samples go before texts are scored."""
    docs = spark.createDataFrame([(i, "a b a c a b", False) for i in range(5)], "doc_id bigint, text string, held_out boolean")
    base, made = Path(shared_dir(spark)).parent, []
    there = set(base.iterdir())
    py.fit(py.count_words(docs).cache(), py.count_pairs(docs).cache(), made)
    assert {x.name for x in set(base.iterdir()) - there} == {Path(x).name for x in made}
    assert len(made) == 5  # words, contexts, seated pairs, keys of the largest words and contexts
