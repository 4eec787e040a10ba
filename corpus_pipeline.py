"""The training-data pipeline: documents through the stages below, each written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abyssal.functions.common import shared_dir, write_and_read
from abyssal.llm import bpe, exact, minhash, mixing, quality
from abyssal.llm.batches import few_or_hashed, packed, quoted

KEEP_SCORE = 0.7
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier, fitted on the training rows' labels, scores under `KEEP_SCORE`."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = quality.fit(docs, labels.filter(quality.in_training(F.col("doc_id"))))
    return docs.filter(quality.scorer(net)("text") >= KEEP_SCORE)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.keep_rows(docs, exact.DigestIndex(spark, shared_dir(spark)).deduplicate(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (shingles of five words, similarity of 80 % or more)."""
    found = minhash.near_duplicates(docs)
    drop = write_and_read(found.filter(~F.col("kept")).select(F.col("doc_id").alias("drop")))
    return packed(docs).join(few_or_hashed(drop), F.col("doc.doc_id") == F.col("drop"), "left_anti").select("doc.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: the words each pass takes of every document, as documents."""
    return mixing.mixed_rows(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix beside its columns, and the text that the ids decode to."""
    own = [c for c in docs.columns if c.lower() not in ("token_ids", "n_tokens", "decoded")]  # columns of these names are replaced
    read = packed(docs).withColumn("read", bpe.tokenizer(spark, VOCABULARY)("doc.text"))
    n_tokens = F.size("read.token_ids").cast("bigint").alias("n_tokens")
    return read.select(*[F.col(f"doc.{quoted(c)}") for c in own], "read.token_ids", n_tokens, "read.decoded")


STAGES = [("quality", classify), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mix), ("bpe", tokenize)]

#: The classifier, MinHash and BPE have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = write_and_read(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
