"""Exact deduplication against a persistent digest index, bucketed and sorted by digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abyssal.functions.common import remove_dirs, write_and_read
from abyssal.llm.batches import few_or_hashed, packed

BLANKS = "[\\x20\\x09-\\x0D]"


def digest_of(text: Column) -> Column:
    """SHA-256 of the text without blanks, as 32 bytes; a null text counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, ""), 256))


class DigestIndex:
    """A table (digest, keep_id) in a folder of its own, one row per text ever seen.

    It is bucketed and sorted by digest, so a new batch is shuffled to the index, never the index to the batch: the batch's
    distinct digests meet it in a sort-merge anti-join, and the ones it lacks are appended. The folder outlives the session;
    opening it again needs the same number of buckets. A batch that is applied twice (after a lost driver, say) finds its own
    rows and gives the same result.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "digest_index_" + "".join(c if c.isalnum() else "_" for c in path)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id {id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def deduplicate(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Per document: id, digest, keep_id, group_size (rows of this batch with the text), n_rows, kept.

        Of equal texts in a batch the row with the most code points stays, then the smallest id (null last); a text the index
        already has keeps the row that was indexed. Rows that repeat both id and text are one document with ``n_rows`` > 1.
        """
        made: list[str] = []
        text = F.coalesce(F.col(text_col), F.lit(""))
        rows = docs.select(F.col(id_col).alias("id"), digest_of(F.col(text_col)).alias("digest"), F.char_length(text).alias("points"))
        digests = write_and_read(rows.groupBy("digest", "id").agg(F.count("*").alias("n_rows"), F.max("points").alias("points")))
        best = F.min(F.struct((-F.col("points")).alias("a"), F.col("id").isNull().alias("b"), F.col("id").alias("id")))
        groups = digests.groupBy("digest").agg(best.alias("best"), F.sum("n_rows").alias("group_size"))
        groups = write_and_read(groups.select("digest", F.col("best.id").alias("best_id"), "group_size"), made)
        self._append(groups)
        # written, so that the join below shuffles both sides and a hot digest can be split
        resolved = write_and_read(groups.join(self.table().hint("merge"), "digest").select("digest", "keep_id", "group_size"))
        remove_dirs(self.spark, made)
        joined = digests.join(resolved, "digest")
        return joined.select(F.col("id").alias(id_col), "digest", "keep_id", "group_size", "n_rows", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"))

    def _append(self, groups: DataFrame) -> None:
        fresh = groups.join(self.table().hint("merge"), "digest", "left_anti")
        fresh = fresh.select("digest", F.col("best_id").alias("keep_id")).repartition(self.buckets, "digest")
        fresh.sortWithinPartitions("digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)


def keep_rows(docs: DataFrame, result: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept whatever their names; a repeated row (same id and text) once."""
    rows = packed(docs)
    key = digest_of(F.col("doc.text"))

    def meet(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        on = key.eqNullSafe(F.col("digest")) & F.col("doc.doc_id").eqNullSafe(F.col("id"))
        return rows.join(few_or_hashed(ids.select(F.col("doc_id").alias("id"), "digest")), on, how)

    made: list[str] = []
    drop = write_and_read(result.filter(~F.col("kept")))
    stay = meet(rows, drop, "left_anti")
    repeated = write_and_read(result.filter(F.col("kept") & (F.col("n_rows") > 1)), made)
    if repeated.isEmpty():
        remove_dirs(docs.sparkSession, made)
        return stay.select("doc.*")
    once = meet(stay, repeated, "left_semi").withColumns({"id": F.col("doc.doc_id"), "text": F.col("doc.text")})
    return meet(stay, repeated, "left_anti").unionByName(once.dropDuplicates(["id", "text"]).select("doc")).select("doc.*")
