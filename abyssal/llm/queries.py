"""The queries of the training-data operators over their whole tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

import corpus_pipeline
from abyssal.functions.common import shared_dir, write_and_read
from abyssal.llm import bpe, chat, covertree, exact, lines, minhash, mixing, pitman_yor, quality, suffixes, trie, urls, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query(
    "op1_cover_tree",
    """
    WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
         ok AS (SELECT vec_id, v FROM e WHERE v IS NOT NULL AND len(list_filter(v, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND list_sum(list_transform(v, lambda c: abs(c))) > 0),
         pairs AS MATERIALIZED (SELECT a.vec_id AS u, b.vec_id AS w FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
         walk AS (SELECT u AS start, u AS here FROM pairs UNION SELECT walk.start, pairs.w FROM walk JOIN pairs ON walk.here = pairs.u),
         c AS (SELECT start, min(here) AS component_id FROM walk GROUP BY start),
         n AS (SELECT u, count(*) AS n_links FROM pairs GROUP BY u)
    SELECT e.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, e.vec_id) AS component_id, coalesce(component_id, e.vec_id) = e.vec_id AS kept
    FROM e LEFT JOIN n ON n.u = e.vec_id LEFT JOIN c ON c.start = e.vec_id
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors linked at a cosine of 0.95 or more."""
    return covertree.near_duplicates(read(spark, sf_dir, "embeddings"), cosine=0.95)


@query(
    "op2_exact_dedup",
    r"""
    WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                      sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM (SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                 first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id FROM d)
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies, against a new digest index."""
    docs = read(spark, sf_dir, "documents")
    found = exact.DigestIndex(spark, shared_dir(spark)).deduplicate(docs.select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a network that has not seen the held-out rows' labels."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    net = quality.fit(docs, labels.filter(quality.in_training(F.col("doc_id"))))
    score = docs.select("doc_id", (~quality.in_training(F.col("doc_id"))).alias("held_out"), quality.scorer(net)("text").alias("score"))
    return score.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op3_minhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies: shingles of four words, similarity of 80 % or more."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), words=4, percent=80)


@query("op5_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text and what they decode to."""
    return bpe.digests(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op6_suffix_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by a string of 400 bytes that also starts elsewhere are taken out of every text."""
    out = suffixes.without_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_pitman_yor")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every text under the model of the training texts."""
    return pitman_yor.score(read(spark, sf_dir, "documents")).drop("perplexity")


@query(
    "op8_url_filters",
    r"""
    WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                      coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
         r AS (SELECT page_id, host, path,
                      CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                           WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                           WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                           WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM u)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return urls.judge(read(spark, sf_dir, "pages"), block=["net/", "example.com/de/"], allow=["example.net/en/", "org/fr/"])


@query(
    "op9_line_dedup",
    r"""
    WITH l AS (SELECT doc_id, coalesce(source, '') AS site, source IS NULL AS nosite, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
         k AS (SELECT *, regexp_replace(line, '^[ 	-
]+|[ 	-
]+$', '', 'g') AS key FROM l),
         b AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT (site, nosite)) >= 8)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE drop_it) AS n_removed,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT drop_it), '')) AS kept_sha256
    FROM (SELECT k.*, b.key IS NOT NULL AS drop_it FROM k LEFT JOIN b USING (key)) GROUP BY doc_id
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that stand on eight sources or more are taken out of every document."""
    out = lines.without_boilerplate(read(spark, sf_dir, "documents"), min_sites=8)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all sources takes of every document."""
    return mixing.taken(read(spark, sf_dir, "documents"))


@query(
    "op11_prefix_trie",
    r"""
    WITH RECURSIVE t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, sha256(coalesce(text, ''))) AS pos
                         FROM conversations WHERE conv_id IS NOT NULL),
         c AS (SELECT conv_id, conv_id - conv_id % 100 AS head,
                      xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(conv_id::VARCHAR, '.'), lambda x: ascii(x)::UBIGINT)),
                          lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda x: 0::UBIGINT)),
                                                        lambda v, x: xor(v >> 1, (v & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT) % 6 AS h
               FROM (SELECT DISTINCT conv_id FROM t)),
         own AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS turns FROM t GROUP BY conv_id),
         r AS (SELECT c.conv_id, coalesce(b.turns[1:c.h::INT], []) || coalesce(o.turns[(c.h + 1)::INT:], []) AS turns
               FROM c JOIN own o USING (conv_id) LEFT JOIN own b ON b.conv_id = c.head),
         p AS (SELECT conv_id, len(turns) AS total, unnest(range(len(turns) + 1)) AS depth, turns FROM r),
         k AS MATERIALIZED (SELECT conv_id, depth, total, sha256(to_json(turns[1:depth])::VARCHAR) AS node, turns[1:depth] AS path,
                   CASE WHEN depth > 0 THEN sha256(to_json(turns[1:depth - 1])::VARCHAR) END AS parent, coalesce(length(turns[depth].text), 0) AS chars FROM p),
         n AS MATERIALIZED (SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, any_value(path) AS path, count(*) AS n_convs, any_value(chars) AS chars,
                      sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = total), '')) AS ends_sha256 FROM k GROUP BY node),
         kids AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
         up AS (SELECT node AS leaf, node, parent FROM n UNION ALL SELECT up.leaf, n.node, n.parent FROM up JOIN n ON n.node = up.parent),
         below AS (SELECT up.node, count(*) FILTER (WHERE kids.node IS NULL) AS n_leaves, sum((l.n_convs - 1) * l.chars)::BIGINT AS saved_tokens
                   FROM up JOIN n l ON l.node = up.leaf LEFT JOIN kids ON kids.node = up.leaf GROUP BY up.node)
    SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
    FROM n LEFT JOIN kids USING (node) JOIN below USING (node) LEFT JOIN n q ON q.node = n.parent
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, each continuing the beginning of its hundred's first."""
    return trie.prefix_trie(*trie.branches(trie.turn_rows(read(spark, sf_dir, "conversations"))))


@query(
    "op12_chat_format",
    r"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
         e AS (SELECT *, regexp_replace(regexp_replace(role, '(<)((?:\\)*(?:/s>|<SYS>>|</SYS>>|<ROLE>>|<TEXT>>|</TEXT>>|s>|\|endoftext\|>))', '\1\\\2', 'g'), '(\[)((?:\\)*(?:INST\]|/INST\]))', '\1\\\2', 'g') AS safe_role,
                      regexp_replace(regexp_replace(text, '(<)((?:\\)*(?:/s>|<SYS>>|</SYS>>|<ROLE>>|<TEXT>>|</TEXT>>|s>|\|endoftext\|>))', '\1\\\2', 'g'), '(\[)((?:\\)*(?:INST\]|/INST\]))', '\1\\\2', 'g') AS safe FROM c)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, sha256(text))) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, sha256(text)) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           sum(length(safe) + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 4 WHEN 'system' THEN 15 ELSE 25 + length(safe_role) END)::BIGINT AS formatted_chars
    FROM e GROUP BY conv_id
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted for training and read back, with one that says the template's own control strings."""
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return chat.read_back(write_and_read(chat.format_conversations(turns, vocabulary)), vocabulary)


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First four whitened components of every embedding."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"), components=4)


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
