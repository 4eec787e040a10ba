import random
from collections import Counter

from abyssal.llm.suffixes import LENGTH, anchors, without_repeats


def brute(texts):
    data = [(t or "").encode() for t in texts]
    windows = Counter(d[i : i + LENGTH] for d in data for i in range(len(d) - LENGTH + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - LENGTH + 1):
            if windows[d[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        spans = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, bytes(c for c, g in zip(d, gone) if not g)))
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    letters = "abcdefgh é"
    noise = lambda k: "".join(rng.choice(letters) for _ in range(k))
    passages = [noise(k) for k in (399, 400, 401, 450, 700, 1500)]
    base = noise(1800)
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.35:  # near copies
            t = list(base)
            for _ in range(rng.randint(1, 5)):
                t[rng.randrange(len(t))] = rng.choice("XYZ")
            t = "".join(t)[rng.randint(0, 40) : len(base) - rng.randint(0, 300)]
        elif kind < 0.8:  # shared passages between others
            t = noise(rng.randint(0, 500)) + rng.choice(passages) + noise(rng.randint(0, 300)) + rng.choice(passages)
        else:
            t = noise(rng.randint(0, 900))
        texts.append(t)
    return texts + [None, "", "a" * 399, "a" * 400, "b" * 401, "c" * 1000, "xyz" * 300, base, base, passages[5] + passages[5]]


def check(spark, texts, largest):
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = without_repeats(docs, largest=largest).collect()
    assert Counter((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == Counter(brute(texts))


def test_anchors_depend_on_the_window_only():
    rng = random.Random(1)
    noise = lambda k: bytes(rng.choice(b"ab") for _ in range(k))
    shared = noise(LENGTH)
    for _ in range(20):
        head, other = noise(rng.randint(0, 900)), noise(rng.randint(0, 900))
        a, b = ({p - len(h) for p in anchors(h + shared + noise(50))[0].tolist()} for h in (head, other))
        assert {p for p in a if 0 <= p <= 368} & {p for p in b if 0 <= p <= 368}


def test_against_brute_force(spark):
    check(spark, corpus(1, 60), 1024)


def test_large_buckets_are_refined_by_spark(spark):
    check(spark, corpus(2, 60), 3)


def test_empty_table(spark):
    assert without_repeats(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
