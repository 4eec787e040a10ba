"""Mixing sources to target weights by fixed-length blocks of words.

Each source's documents are laid end to end in a pseudorandom order and cut into blocks of ``block_words`` words (the last
one is the source's rest). A mix asks each source for a whole number of words. It takes them in passes: a pass goes through the
source's blocks, its rest too, in the order of a pseudorandom permutation of block indexes, and the last slot takes part of a block.
How many slots of a source each output shard gets is a multinomial draw whose total stays at the target. The counts decide: the
first shard takes the source's first slots, the next shard those after them. Slots meet blocks by (source, index) in one join.

All of it is DataFrame work. Positions come from sums per (source, bucket) and a running sum inside each bucket, so a source of
any size is spread over many tasks.

Null and empty texts have size 0 and are never taken. A null source is a source of its own, the last one. Rows that repeat an id
keep their own places; rows that also repeat the text are interchangeable. No rows: no result.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from abyssal.functions.common import remove_dirs, write_and_read
from abyssal.llm.batches import packed, quoted

BLANK = "[\\x20\\x09-\\x0D]+"
ROUNDS = 24  # of the permutation
BUCKET_ROWS = 2048
CHUNK = 8192  # slots that are made at once
MOST_TASKS = 4096  # that make slots; more chunks share tasks
WORD = "[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*"  # with the blanks behind it
BLANKS = " \t\n\v\f\r"


@dataclass(frozen=True)
class Mix:
    """Weights go round the sources in code point order (null last); a target stops at ``cap`` times its source's words."""

    weights: tuple[float, ...] = (5, 2, 1)
    share: float = 1.5  # words of the mix, in parts of all words
    cap: float = 2.0
    block_words: int = 256
    shards: int = 16
    seed: int = 1


def word_count(text: Column) -> Column:
    blanks = F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, " ")
    inner = F.btrim(blanks, F.lit(" "))
    return F.when(inner == "", F.lit(0)).otherwise(F.char_length(inner) - F.char_length(F.replace(inner, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def targets(sizes: list[tuple[str | None, int]], mix: Mix) -> list[tuple[str | None, int, float]]:
    """(source, words, target): shares by weight, with what exceeds a cap shared again among the rest by weight.

    One entry per source; the list of sources is small (it is the mix's configuration), not the corpus.
    """
    order = sorted(sizes, key=lambda s: (s[0] is None, [ord(c) for c in s[0] or ""]))
    weight = [mix.weights[i % len(mix.weights)] for i in range(len(order))]
    caps, target = [mix.cap * n for _, n in order], [0.0] * len(order)
    left, open_ = mix.share * sum(n for _, n in order), set(range(len(order)))
    while open_:
        unit = left / sum(weight[i] for i in open_)
        over = {i for i in open_ if unit * weight[i] > caps[i]}
        if not over:
            for i in open_:
                target[i] = unit * weight[i]
            break
        for i in over:
            target[i] = caps[i]
            left -= caps[i]
        open_ -= over
    return [(s, n, t) for (s, n), t in zip(order, target)]


def permuted(index: Column, n: Column, key: Column, back: bool = False) -> Column:
    """Position ``index`` of a pseudorandom permutation of 0..n-1 (swap-or-not rounds; each is its own inverse), or ``back`` from it."""

    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        swap = F.pmod(F.xxhash64(key, r, F.greatest(x, partner)), F.lit(2)) == 1
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(*map(F.lit, (ROUNDS, 1) if back else (1, ROUNDS))), index, step)


def _placed(sized: DataFrame, rows: int, seed: int) -> DataFrame:
    """Start of every document with words in its source's stream of words."""
    buckets = max(16, -(-rows // BUCKET_ROWS))
    keyed = sized.filter("size > 0").withColumn("_h", F.xxhash64(F.lit(seed), "_key", "_print")).withColumn("_bucket", F.pmod("_h", F.lit(buckets)))
    inside = W.partitionBy("_source", "_bucket").orderBy("_h", "_key", "_print").rowsBetween(W.unboundedPreceding, -1)
    # counts per (source, bucket) are one row for some thousand documents
    sums = keyed.groupBy("_source", "_bucket").agg(F.sum("size").alias("_words"))
    before = W.partitionBy("_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("_source", "_bucket", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_offset"))
    placed = keyed.withColumn("_within", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, ["_source", "_bucket"])
    return placed.withColumn("_start", F.col("_offset") + F.col("_within")).drop("_h", "_bucket", "_within", "_offset")


def slots(spark, goals: list[tuple[int, int, int]], mix: Mix) -> DataFrame:
    """(source number, pass, slot, shard, block, words): what the mix takes. ``goals``: number, source words, words to take."""
    goals = [g for g in goals if g[1] and g[2]]
    if not goals:
        schema = T.StructType([T.StructField("_source", T.LongType())])
        return spark.createDataFrame([], schema).selectExpr("_source", "0L AS _pass", "0L AS _slot", "0 AS _shard", "0L AS _block", "0L AS _words")
    size = F.lit(mix.block_words)
    counts = shard_counts(spark, [(s, slot_count(n, t, mix)) for s, n, t in goals], mix)
    ends = {s: list(itertools.accumulate(counts.get((s, k), 0) for k in range(mix.shards))) for s, _, _ in goals}
    rows = ", ".join(f"(bigint({s}), bigint({n}), bigint({t}), array({', '.join(f'bigint({e})' for e in ends[s])}))" for s, n, t in goals)
    g = spark.sql(f"SELECT * FROM VALUES {rows} AS t(_source, _have, _take, _ends)")
    last_pass = F.ceil(F.col("_take") / F.col("_have")) - 1
    g = g.withColumn("_pass", F.explode(F.sequence(F.lit(0).cast("bigint"), last_pass)))
    g = g.withColumn("_want", F.least(F.col("_take") - F.col("_pass") * F.col("_have"), F.col("_have")))
    # the last block is the source's rest; slots after the one that draws it start so many words earlier
    key = F.xxhash64(F.lit(mix.seed), F.col("_source"), F.col("_pass"))
    g = g.withColumn("_blocks", F.ceil(F.col("_have") / size)).withColumn("_short", F.col("_blocks") * size - F.col("_have"))
    g = g.withColumn("_rest", permuted(F.col("_blocks") - 1, F.col("_blocks"), key, back=True))
    g = g.withColumn("_slots", F.least(F.col("_blocks"), F.ceil((F.col("_want") + F.col("_short")) / size)))
    g = _numbered(g, "_slots", "_slot", sum(slot_count(n, t, mix) for _, n, t in goals))
    block = permuted(F.col("_slot"), F.col("_blocks"), key)
    # a pass follows full ones, so this is the slot's place among all of its source
    place = F.col("_pass") * F.col("_blocks") + F.col("_slot")
    shard = F.size(F.filter("_ends", lambda e: e <= place))
    start = F.col("_slot") * size - F.when(F.col("_slot") > F.col("_rest"), F.col("_short")).otherwise(0)
    holds = size - F.when(F.col("_slot") == F.col("_rest"), F.col("_short")).otherwise(0)
    words = F.least(holds, F.col("_want") - start)
    made = g.select("_source", "_pass", "_slot", shard.alias("_shard"), block.alias("_block"), words.alias("_words"))
    return made.filter("_words > 0")


def slot_count(have: int, take: int, mix: Mix) -> int:
    """Slots of a source over all passes; the last one of the last pass may turn out empty."""
    blocks, full = -(-have // mix.block_words), -(-take // have) - 1
    return full * blocks + min(blocks, -(-(take - full * have + blocks * mix.block_words - have) // mix.block_words))


def shard_counts(spark, totals: list[tuple[int, int]], mix: Mix) -> dict[tuple[int, int], int]:
    """A multinomial draw for each source of ``totals`` (number, slots): how many of its slots each shard gets.

    Each of the slots is one uniform draw; they are counted where they are made, so a row per source and shard is all that leaves.
    """
    rows = ", ".join(f"(bigint({s}), bigint({n}))" for s, n in totals)
    draws = _numbered(spark.sql(f"SELECT * FROM VALUES {rows} AS t(_source, _slots)"), "_slots", "_draw", sum(n for _, n in totals))
    shard = F.pmod(F.xxhash64(F.lit(mix.seed), F.lit("shard"), "_source", "_draw"), F.lit(mix.shards)).cast("int")
    return {(r["_source"], r["shard"]): r["n"] for r in draws.groupBy("_source", shard.alias("shard")).agg(F.count("*").alias("n")).collect()}


def _numbered(rows: DataFrame, count: str, name: str, total: int) -> DataFrame:
    """Each row ``count`` times with a number from 0, made in chunks that are dealt to as many tasks (a number, lest they be merged)."""
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / CHUNK)))
    dealt = rows.withColumn("_chunk", chunk).repartition(min(MOST_TASKS, total // CHUNK + 1), *rows.columns[:1], "_chunk")
    first = F.col("_chunk") * CHUNK
    return dealt.withColumn(name, F.explode(F.sequence(first, F.least(first + CHUNK, F.col(count)) - 1)))


@dataclass
class Mixed:
    """``sized``: a row per document with _key, _source, size, source_size, target. ``pieces``: the words each slot takes of a document."""

    sized: DataFrame
    pieces: DataFrame


def mix_documents(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Mixed:
    """Pieces: _key, _print (the document), _shard, _pass, _slot, _from and _count (words of the document, in its order)."""
    spark, made = docs.sparkSession, []
    text = F.col(text_col)
    columns = [F.col(id_col).alias("_key"), F.xxhash64(text).alias("_print"), F.col(source_col).cast("string").alias("_name"), word_count(text).alias("size")]
    sized = write_and_read(docs.select(columns))
    totals = sized.groupBy("_name").agg(F.sum("size").alias("words"), F.count("*").alias("rows")).collect()  # a row per source
    goals = targets([(r["_name"], r["words"]) for r in totals], mix)
    number = {s: i for i, (s, _, _) in enumerate(goals)}
    schema = "_name string, _source bigint, source_size bigint, target double"
    known = spark.createDataFrame([(s, number[s], n, t) for s, n, t in goals], schema)
    sized = sized.join(F.broadcast(known), sized["_name"].eqNullSafe(known["_name"]), "left").drop("_name")
    placed = _placed(sized, sum(r["rows"] for r in totals), mix.seed)
    size = F.lit(mix.block_words)
    end = F.col("_start") + F.col("size")
    block = F.explode(F.sequence(F.floor(F.col("_start") / size), F.floor((end - 1) / size)))
    parts = placed.select("_key", "_print", "_source", "_start", "size", block.alias("_block"))
    takes = slots(spark, [(number[s], n, round(min(t, mix.cap * n))) for s, n, t in goals], mix)
    # slots grow with the corpus although their plan starts from a few rows, so they may not be broadcast
    met = parts.join(takes.hint("merge"), ["_source", "_block"])
    low = F.greatest(F.col("_start"), F.col("_block") * size)
    high = F.least(F.col("_start") + F.col("size"), F.col("_block") * size + F.col("_words"))
    met = met.filter(high > low)
    pieces = met.select("_key", "_print", "_start", "_source", "_shard", "_pass", "_slot", (low - F.col("_start")).alias("_from"), (high - low).alias("_count"))
    remove_dirs(spark, made)
    return Mixed(sized, pieces)


def taken(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words the mix takes, repeats counted)."""
    mixed = mix_documents(docs, mix)
    # equal rows share what their places got; each gets its part, the first ones one word more
    per = mixed.pieces.groupBy("_key", "_print", "_source").agg(F.sum("_count").alias("_all"))
    keys = ["_key", "_print", "_source"]
    rows = mixed.sized.groupBy(*keys, "size", "source_size", "target").agg(F.count("*").alias("_n"))
    met = rows.join(per, [rows[k].eqNullSafe(per[k]) for k in keys], "left").select(*[rows[c] for c in rows.columns], F.coalesce("_all", F.lit(0)).alias("_all"))
    each = met.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    share = F.floor(F.col("_all") / F.col("_n")) + (F.col("_i") <= F.col("_all") % F.col("_n")).cast("bigint")
    return each.select(F.col("_key").alias("doc_id"), "size", "source_size", "target", share.cast("bigint").alias("taken"))


def mixed_rows(docs: DataFrame, mix: Mix = Mix(), shard_col: str | None = None) -> DataFrame:
    """The mix as documents: a row for each run of neighbouring words that a pass takes, with the document's other columns.

    A run is cut from the text with the spacing inside it; a run of all words is the whole text. n_chars is counted again. With
    ``shard_col`` runs end where the output shard changes too, and a column of that name holds it. Documents of which nothing is
    taken are not in the mix. Columns of any name are carried along.
    """
    mixed = mix_documents(docs, mix)
    keys = ["_key", "_print", "_source", "_start", "_pass", *(["_shard"] if shard_col else [])]
    part = F.struct(F.col("_from").alias("a"), (F.col("_from") + F.col("_count")).alias("b"))
    runs = mixed.pieces.groupBy(*keys).agg(F.sort_array(F.collect_list(part)).alias("parts"))
    begins = F.filter("parts", lambda p, i: F.coalesce(F.get("parts", i - 1)["b"] != p["a"], F.lit(True)))
    ends = F.filter("parts", lambda p, i: F.coalesce(F.get("parts", i + 1)["a"] != p["b"], F.lit(True)))
    shard = F.col("_shard") if shard_col else F.lit(0)
    runs = runs.select("_key", "_print", shard.alias("shard"), F.zip_with(begins, ends, lambda x, y: F.struct(x["a"].alias("a"), y["b"].alias("b"))).alias("runs"))
    on = F.col("doc.doc_id").eqNullSafe(F.col("_key")) & (F.xxhash64("doc.text") == F.col("_print"))
    joined = _once(docs, mixed.sized).join(runs, on)

    def cut(words: Column, run: Column) -> Column:
        piece = F.array_join(F.slice(words, (run["a"] + 1).cast("int"), (run["b"] - run["a"]).cast("int")), "")
        return F.when((run["a"] == 0) & (run["b"] == F.size(words)), F.col("doc.text")).otherwise(F.btrim(piece, F.lit(BLANKS)))

    # the one-element array binds the words, so that they are found once for all runs
    words = F.array(F.regexp_extract_all("doc.text", F.lit(WORD), F.lit(0)))
    texts = F.transform(words, lambda w: F.transform("runs", lambda r: cut(w, r)))[0]
    out = joined.select("doc", "shard", F.explode(texts).alias("text"))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    columns = [new.get(c, F.col(f"doc.{quoted(c)}")).alias(c) for c in docs.columns]
    return out.select(*columns, *([F.col("shard").alias(shard_col)] if shard_col else []))


def _once(docs: DataFrame, sized: DataFrame) -> DataFrame:
    """Rows under ``doc``; those that repeat id and text only once: the pieces of all their places go to that one."""
    rows = packed(docs)
    repeated = write_and_read(sized.groupBy("_key", "_print").agg(F.count("*").alias("_n")).filter("_n > 1"))
    if repeated.isEmpty():
        return rows
    on = F.col("doc.doc_id").eqNullSafe(F.col("_key")) & (F.xxhash64("doc.text") == F.col("_print"))
    several = rows.join(repeated, on, "left_semi").withColumns({"id": F.col("doc.doc_id"), "text": F.col("doc.text")})
    return rows.join(repeated, on, "left_anti").unionByName(several.dropDuplicates(["id", "text"]).select("doc"))
