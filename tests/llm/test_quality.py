import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from abyssal.llm import quality
from abyssal.llm.quality import HALF, STRIDE, ByteNet, TrainingBounds


def corpus(n=400):
    rng = random.Random(1)
    words = "the sea is calm and deep water moves below with slow cold light over sand".split()
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(20, 120)))
        bad = i % 4 == 0
        rows.append((i, text.upper().replace(" ", "!! ") if bad else text.capitalize() + ".", int(not bad)))
    return rows


def test_held_out_accuracy_and_odd_texts(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1.5) for i, t, _ in rows] + [(None, None, 0.0), (900, "", 0.0), (901, "x" * 300_000, 0.0), (1, rows[1][1], 0.0)], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (5, None)], "doc_id bigint, quality int")
    net = quality.fit(docs, labels.filter(quality.in_training(F.col("doc_id"))), TrainingBounds(rows=250, epochs=4))
    out = docs.withColumn("_s", quality.scorer(net)("text")).collect()
    assert len(out) == docs.count() and all(0 <= r._s <= 1 for r in out)
    held = {i: q for i, _, q in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    right = [(r._s >= 0.7) == bool(held[r.doc_id]) for r in out if r.doc_id in held]
    assert len(right) > 60 and np.mean(right) > 0.97
    again = quality.fit(docs.repartition(3), labels.filter(quality.in_training(F.col("doc_id"))), TrainingBounds(rows=250, epochs=4))
    assert all((net.p[k] == again.p[k]).all() for k in net.p)


def test_training_rows_rule(spark):
    ids = spark.range(200).select("id", quality.in_training(F.col("id")).alias("t")).collect()
    assert all(r.t == (zlib.crc32(str(r.id).encode()) % 4 != 2) for r in ids)


def test_scores_do_not_depend_on_the_batch_and_see_the_whole_text():
    net = ByteNet(3)
    texts = [b"abc", b"", b"some text " * 500, b"q" * 20_000, b"n" * 5000 + b"Z!Z!Z!Z!" + b"n" * 5000]
    alone = [net.score([t])[0] for t in texts]
    assert np.allclose(net.score(texts), alone, atol=1e-5)
    plain = net.pooled(*quality.layout([b"n" * 10_008]))[0]
    assert not np.allclose(plain, net.pooled(*quality.layout([texts[4]]))[0])
    long_ = (b"lorem ipsum dolor " * 200_000)[: STRIDE * HALF * 25_000]
    whole = net.pooled(*quality.layout([long_]))[0]
    assert np.allclose(whole, net.pooled_long(long_), atol=1e-5)


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    net = quality.fit(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert docs.limit(0).withColumn("s", quality.scorer(net)("text")).collect() == []
    assert 0 < docs.select(quality.scorer(net)("text").alias("s")).first().s < 1


def test_gradients_against_differences():
    net, rng = ByteNet(5), np.random.default_rng(2)
    net.p |= {k: net.p[k].astype(np.float64) for k in ("w1", "b1", "w2", "b2")}
    texts = [bytes(rng.integers(97, 123, n, dtype=np.uint8)) for n in (50, 400, 900)]
    labels = np.array([1.0, 0.0, 1.0])

    def loss():
        p = net.head(net.pooled(*quality.layout(texts))[0])[1]
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    grad = net.gradients(texts, labels)
    for k, at in (("w1", (3, 2)), ("b1", (4,)), ("w2", (1,)), ("b2", (0,))):
        keep = net.p[k][at]
        net.p[k][at] = keep + 1e-4
        up = loss()
        net.p[k][at] = keep - 1e-4
        down = loss()
        net.p[k][at] = keep
        assert abs((up - down) / 2e-4 - grad[k][at]) < 1e-3
