import random

import pandas as pd
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_minhash import brute
from tests.llm.test_exact import norm


def tables(tmp_path):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in ("sea", "reef", "tide", "sand", "kelp") for b in ("ward", "s", "ing", "line", "bed", "less")]
    rows = []
    for i in range(240):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(40, 90))) + "."
        rows.append([i, text if i % 5 else text.upper().replace(" ", "!! "), "en", f"src{i % 3}", 0])
    for i in range(240, 300):  # exact and near copies
        text = rows[rng.randrange(1, 240)][1]
        rows.append([i, text.replace(" ", "  ") if i % 2 else text + " extra", "en", "src1", 0])
    for r in rows:
        r[4] = len(r[1])
    docs = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"])
    docs.to_parquet(tmp_path / "documents.parquet")
    labels = pd.DataFrame({"doc_id": range(240), "quality": [int(i % 5 > 0) for i in range(240)], "toxic": 0}).astype({"quality": "int32", "toxic": "int32"})
    labels.to_parquet(tmp_path / "labels.parquet")
    return docs


def test_every_stage_on_its_own_input(spark, tmp_path):
    docs = tables(tmp_path)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "bpe"]
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"in{k}.parquet")
        seen[-1].to_parquet(path)
        seen.append(stage(spark, spark.read.parquet(path), str(tmp_path)).toPandas())
    kept, exact, near, mixed, tokens = seen[1:]
    for out in seen[1:5]:
        assert list(out.columns) == list(docs.columns)
    good = {r.doc_id for r in docs.itertuples() if not r.text.isupper() and "!!" not in r.text}
    assert set(kept.doc_id) == good
    groups = {}
    for r in kept.itertuples():
        groups.setdefault(norm(r.text), []).append((-len(r.text), r.doc_id))
    assert set(exact.doc_id) == {min(g)[1] for g in groups.values()}
    component = brute(list(zip(exact.doc_id, exact.text)), 5, 80)
    assert set(near.doc_id) == set(component.values()) and len(near) == near.doc_id.nunique()
    size = {r.doc_id: len(r.text.split()) for r in near.itertuples()}
    taken = mixed.groupby("doc_id").text.apply(lambda t: sum(len(x.split()) for x in t))
    assert all(taken[i] <= 2 * size[i] for i in taken.index)
    assert abs(taken.sum() - 1.5 * sum(size.values())) <= 3
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in tokens.itertuples():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert list(r.token_ids) == ids and r.n_tokens == len(ids) and r.decoded == library.decode(ids, skip_special_tokens=False)


def test_empty_documents(spark, tmp_path):
    tables(tmp_path)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet")).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


def test_extra_columns_survive_whatever_their_names(spark, tmp_path):
    """Only the tokenizer's three result columns are replaced where the documents have columns of these names."""
    tables(tmp_path)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    extra = ["_score", "_drop", "_id", "_digest", "digest", "keep_id", "_key", "_print", "_runs", "drop", "doc", "read", "component_id", "a b.c"]
    docs = docs.filter("doc_id < 120 or doc_id >= 240").select("*", *[F.concat(F.lit(f"{c}/"), "doc_id").alias(c) for c in extra], F.lit("mine").alias("decoded"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert sorted(out.columns) == sorted([*docs.columns, *(["token_ids", "n_tokens"] if name == "bpe" else [])])
        out.write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        rows = docs.collect()
        assert rows and all(r[c] == f"{c}/{r.doc_id}" for r in rows for c in extra)
    assert all(r.decoded != "mine" for r in rows)
