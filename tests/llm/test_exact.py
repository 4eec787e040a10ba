import hashlib
import re

from abyssal.functions.common import shared_dir
from abyssal.llm.exact import DigestIndex, keep_rows


def norm(t):
    return re.sub("[\x20\x09-\x0d]", "", t or "")


ROWS = [(1, "a b"), (2, "ab"), (3, " a\tb\n"), (4, "A b"), (5, None), (6, ""), (7, " "), (8, "x y" * 5000), (9, "xy" * 5000), (10, "e\u00a0"), (None, "ab  "), (12, "q"), (12, "q"), (12, "r")]
SCHEMA = "doc_id bigint, text string"


def test_groups_against_brute_force(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = DigestIndex(spark, shared_dir(spark)).deduplicate(docs).collect()
    groups = {}
    for i, t in ROWS:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, i))
    want = {(i, hashlib.sha256(norm(t).encode()).hexdigest(), min(groups[norm(t)])[3], len(groups[norm(t)])) for i, t in ROWS}
    assert {(r.doc_id, r.digest.hex(), r.keep_id, r.group_size) for r in got} == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    assert len(got) == len(want)  # a row that repeats id and text is one document


def test_index_outlives_a_batch(spark):
    path = shared_dir(spark)
    first = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    index = DigestIndex(spark, path, buckets=4)
    assert all(r.kept for r in index.deduplicate(first).collect())
    spark.sql(f"DROP TABLE {index.name}")  # another session finds the folder again
    index = DigestIndex(spark, path, buckets=4)
    second = spark.createDataFrame([(0, "a "), (3, "c"), (4, "c c")], SCHEMA)
    for _ in range(2):  # applied twice, the same result
        got = {r.doc_id: (r.keep_id, r.kept) for r in index.deduplicate(second).collect()}
        assert got == {0: (1, False), 3: (3, True), 4: (4, True)}
    assert index.table().count() == 4
    plan = first.selectExpr("cast(text as binary) AS digest").join(index.table().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan


def test_kept_rows(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in ROWS], SCHEMA + ", digest int")
    out = keep_rows(docs, DigestIndex(spark, shared_dir(spark)).deduplicate(docs))
    assert out.columns == ["doc_id", "text", "digest"]
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(3, " a\tb\n"), (4, "A b"), (7, " "), (8, "x y" * 5000), (10, "e\u00a0"), (12, "q"), (12, "r")]
    assert keep_rows(docs.limit(0), DigestIndex(spark, shared_dir(spark)).deduplicate(docs.limit(0))).collect() == []
