import random

from abyssal.llm.components import connected_components
from abyssal.llm.minhash import near_duplicates


def brute(rows, words, percent):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        k = min(words, len(w))
        sets.setdefault(i, []).append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set())
    ids, root = list(sets), {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if any(p and q and 100 * len(p & q) >= percent * len(p | q) for p in sets[a] for q in sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: find(i) for i in ids}


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocab) for _ in range(rng.randint(30, 120))] for _ in range(12)]
    passage = [rng.choice(vocab) for _ in range(40)]
    rows = []
    for i in range(n):
        words = list(rng.choice(base)) if rng.random() < 0.7 else passage + [rng.choice(vocab) for _ in range(20)]
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((i, " ".join(words)))
    return rows


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}


def test_against_brute_force(spark):
    for words in (4, 5):
        rows = corpus(words)
        rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one two"), (1004, "ONE  two"), (1005, rows[3][1]), (1006, rows[3][1].upper())]
        rows += [(1005, rows[3][1])]  # a repeated row
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
        got = near_duplicates(docs, words=words).collect()
        want = brute(rows, words, 80)
        assert {r.doc_id: r.component_id for r in got} == want
        assert len(got) == len(rows)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)
        assert {r.doc_id: r.n_shingles for r in got}[1003] == 1


def test_null_ids_long_texts_and_empty_table(spark):
    long_text = " ".join(f"t{i % 5000}" for i in range(60_000))
    docs = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (5, long_text), (9, long_text + " end")], "doc_id bigint, text string")
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert got == {(None, None, True), (5, 5, True), (9, 5, False)}
    assert near_duplicates(docs.limit(0)).collect() == []
