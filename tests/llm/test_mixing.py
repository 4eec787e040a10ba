import random
import re

from abyssal.llm.mixing import Mix, mix_documents, mixed_rows, permuted, taken, targets
from pyspark.sql import functions as F


def documents(spark, n=200, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rng.choice(["b", "é", "tiny" if i < 12 else "z"])
        rows.append((i, " ".join(f"d{i}x{j}" for j in range(rng.randint(1, 900))), source))
    rows += [(1000, None, "b"), (1001, "", None), (1002, " \t ", "b"), (1003, "x y z", None), (2000, "same text", "b"), (2000, "same text", "b"), (None, "no id", "b")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string"), rows


def test_permutation(spark):
    for n in (1, 2, 7, 1000):
        got = spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(9).cast("bigint")).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))
    assert [r.p for r in got] != list(range(1000))


def test_targets():
    got = {s: (n, t) for s, n, t in targets([("b", 100), (None, 50), ("a", 1000)], Mix())}
    assert abs(sum(t for _, t in got.values()) - 1.5 * 1150) < 1e-9
    assert got["b"][1] == 200 and got[None][1] == 100 and abs(got["a"][1] - 1425) < 1e-9
    assert targets([], Mix()) == []


def test_taken(spark):
    docs, rows = documents(spark)
    got = taken(docs.repartition(7)).collect()
    again = taken(docs.repartition(3)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert sorted(got, key=key) == sorted(again, key=key) and len(got) == len(rows)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    source, words, goal = {}, {}, {}
    by_id = {i: s for i, _, s in rows}
    for _, t, s in rows:
        words[s] = words.get(s, 0) + count(t)
    for r in got:
        s = by_id[r.doc_id]
        source[s] = source.get(s, 0) + r.taken
        goal[s] = r.target
        assert r.source_size == words[s] and 0 <= r.taken <= 2 * r.size
    assert all(abs(source[s] - goal[s]) <= 1 for s in goal)
    assert taken(docs.limit(0)).collect() == []


def test_pieces_and_rows(spark):
    docs, rows = documents(spark, 60)
    mix = Mix(block_words=64)
    pieces = mix_documents(docs, mix).pieces
    assert pieces.groupBy("_source", "_pass", "_slot").agg(F.sum("_count").alias("n")).filter("n > 64").count() == 0
    extra = ["_other", "_key", "_print", "_run", "_runs", "_w", "doc", "shard", "parts", "a.b"]
    given = docs.withColumn("n_chars", F.lit(0).cast("bigint")).select("*", *[F.lit(c).alias(c) for c in extra])
    out = mixed_rows(given, mix)
    assert out.columns == ["doc_id", "text", "source", "n_chars", *extra]
    got = out.collect()
    assert all(r[c] == c for r in got for c in extra) and all(r.n_chars == len(r.text) for r in got)
    assert sum(len(r.text.split()) for r in got) == pieces.agg(F.sum("_count")).first()[0]


def test_runs_are_cut_from_the_text(spark):
    """No row joins words that are not neighbours, spacing stays, a whole text is the text itself."""
    rng = random.Random(3)
    blanks = [" ", "  ", "\n", "\t\r\n", "\v\f"]
    rows = [(i, rng.choice(["", " "]) + "".join(f"d{i}x{j}" + rng.choice(blanks) for j in range(rng.choice([3, 40, 700]))), f"s{i % 3}") for i in range(40)]
    texts, whole = {i: t for i, t, _ in rows}, 0
    out = mixed_rows(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), Mix(block_words=16)).collect()
    for r in out:
        assert r.text in texts[r.doc_id]
        whole += r.text == texts[r.doc_id]
        words = [int(w.split("x")[1]) for w in r.text.split()]
        assert words == list(range(words[0], words[0] + len(words)))
    assert whole and len(out) > 2 * len(rows)


def test_shards_follow_the_draw(spark):
    """The slots of a shard are as many as its draw, lie in a row, and the counts vary as a multinomial draw does."""
    from abyssal.llm.mixing import shard_counts, slot_count, slots

    mix = Mix(block_words=4, shards=8)
    goals = [(0, 40003, 60001), (1, 999, 1998), (2, 7, 3)]
    totals = [(s, slot_count(n, t, mix)) for s, n, t in goals]
    counts = shard_counts(spark, totals, mix)
    assert all(sum(counts.get((s, k), 0) for k in range(8)) == n for s, n in totals)
    got = {}
    for r in slots(spark, goals, mix).orderBy("_source", "_pass", "_slot").collect():
        got.setdefault(r["_source"], []).append(r["_shard"])
    for s, n in totals:
        assert got[s] == sorted(got[s]) and n - 1 <= len(got[s]) <= n
        want = [counts.get((s, k), 0) for k in range(8)]
        assert sum(abs(got[s].count(k) - want[k]) for k in range(8)) == n - len(got[s])
    n, chi = totals[0][1], []
    for seed in range(6):
        c = shard_counts(spark, totals[:1], Mix(block_words=4, shards=8, seed=seed))
        chi.append(sum((c[0, k] - n / 8) ** 2 / (n / 8) for k in range(8)))
    assert 1 < sum(chi) / 6 < 20 and len(set(chi)) == 6  # seven degrees of freedom
    docs, _ = documents(spark, 30)
    rows = mixed_rows(docs, Mix(block_words=64), shard_col="out").collect()
    assert {r["out"] for r in rows} <= set(range(16)) and len({r["out"] for r in rows}) > 8
    assert sum(len(r.text.split()) for r in rows) == sum(len(r.text.split()) for r in mixed_rows(docs, Mix(block_words=64)).collect())


def test_rest_block_is_drawn_in_part_passes(spark):
    """Of a source of four blocks and a rest, passes of half of it draw the rest for some seeds, and keep their size."""
    from abyssal.llm.mixing import slots

    drawn = set()
    for seed in range(12):
        rows = slots(spark, [(0, 1100, 550)], Mix(seed=seed)).collect()
        assert sum(r["_words"] for r in rows) == 550 and len({r["_block"] for r in rows}) == len(rows)
        assert all(r["_words"] <= (76 if r["_block"] == 4 else 256) for r in rows)
        drawn |= {r["_block"] for r in rows}
    assert drawn == {0, 1, 2, 3, 4}
