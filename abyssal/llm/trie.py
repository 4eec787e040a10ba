"""Prefix trie of conversations: what they share from their first turn on, in balanced parentheses.

Conversations become sequences of turn digests; equal ones are counted once. Sorted by ranges, every task holds one shard of
neighbouring sequences and encodes its trie in preorder as balanced parentheses: excess blocks with their least and largest value give
`findclose`, which delimits subtrees; ranks of "()" count their leaves; running sums give what is saved below. Only the first and the
last path of a shard can also lie in a neighbour: these spines are merged by a grouping and form a small trie of their own, whose
values are added to those of the shards. Sequences of over ``LONGEST`` turns are cut: a later cut hangs below the node that the
earlier ones lead to, and gives that node its totals.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import remove_dirs, write_and_read
from abyssal.llm.batches import few_or_hashed
from abyssal.llm.sequences import arrow_rows, hashed_in_order, in_ranges, pieces_of, tasks_for

LONGEST = 256
WIDTH = 16  # bytes of a digest
BLOCK = 64
TURNS_PER_TASK = 200_000
NOTHING = sha256(b"").hexdigest()
NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"


def _key(data: bytes) -> bytes:
    return sha256(data).digest()[:WIDTH]


def _key_of(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 2 * WIDTH))


class Parentheses:
    """A forest given by its depths in preorder, as balanced parentheses with a min-max tree over blocks of excess."""

    def __init__(self, depth: np.ndarray):
        self.depth = depth = np.asarray(depth, dtype=np.int64)
        n = len(depth)
        self.opens = 2 * np.arange(n) - depth
        self.bits = np.zeros(2 * n, dtype=bool)
        self.bits[self.opens] = True
        excess = np.cumsum(np.where(self.bits, 1, -1))
        blocks = max(1, -(-2 * n // BLOCK))
        self.leaves_from = 1 << (blocks - 1).bit_length()
        self.excess = np.full((blocks, BLOCK), -1, dtype=np.int64)
        self.excess.ravel()[: 2 * n] = excess
        self.low = np.full(2 * self.leaves_from, 1 << 60, dtype=np.int64)
        self.high = np.full(2 * self.leaves_from, -1, dtype=np.int64)
        self.low[self.leaves_from:self.leaves_from + blocks] = self.excess.min(axis=1)
        self.high[self.leaves_from:self.leaves_from + blocks] = self.excess.max(axis=1)
        at = self.leaves_from
        while at > 1:
            half = at // 2
            self.low[half:at] = np.minimum(self.low[at:2 * at:2], self.low[at + 1:2 * at:2])
            self.high[half:at] = np.maximum(self.high[at:2 * at:2], self.high[at + 1:2 * at:2])
            at = half
        self.close = np.concatenate([self._findclose(slice(i, i + 65_536)) for i in range(0, n, 65_536)]) if n else self.opens
        #: preorder index behind each node's subtree: the opening parentheses up to its closing one
        self.end = (self.close + 1 + depth) // 2
        pairs = self.bits & ~np.append(self.bits[1:], True)
        self.is_leaf = pairs[self.opens]
        self._rank = np.concatenate([[0], np.cumsum(pairs)])

    def _holds(self, at: np.ndarray, goal: np.ndarray) -> np.ndarray:
        return (self.low[at] <= goal) & (goal <= self.high[at])

    def _findclose(self, part: slice) -> np.ndarray:
        """First position behind each opening parenthesis where the excess is back at the node's depth."""
        opens, goal = self.opens[part], self.depth[part]
        block = opens // BLOCK
        hits = (self.excess[block] == goal[:, None]) & (np.arange(BLOCK) > (opens % BLOCK)[:, None])
        close = block * BLOCK + hits.argmax(axis=1)
        far = np.flatnonzero(~hits.any(axis=1))
        goal = goal[far]
        at = self.leaves_from + block[far] + 1
        while (missed := ~self._holds(at, goal)).any():  # to the right, and up where a pair of blocks ends
            at = np.where(missed, np.where(at % 2, (at + 1) >> 1, at + 1), at)
        while (inner := at < self.leaves_from).any():
            left = np.where(inner, 2 * at, at)
            at = np.where(inner & ~self._holds(left, goal), left + 1, left)
        block = at - self.leaves_from
        close[far] = block * BLOCK + (self.excess[block] == goal[:, None]).argmax(axis=1)
        return close

    def leaf_pairs(self) -> np.ndarray:
        return self._rank[self.close + 1] - self._rank[self.opens]

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sum over each node's subtree, the node included."""
        running = np.concatenate([[0], np.cumsum(values)])
        return running[self.end] - running[:-1]


def _common_turns(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle * WIDTH] == b[:middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


FOUND = f"kind tinyint, key binary, parent_key binary, chars bigint, prefix binary, path binary, {NODE}"
DONE, ROOT, SPINE = range(3)


def _shard(rows: Iterator[tuple], level: int, longest: int) -> Iterator[tuple]:
    """The nodes of sorted distinct sequences (prefix, seq, convs, conv_id, chars, and what hangs below: children, leaves, saved)."""
    prefixes, seqs, convs, least, hung = [], [], [], [], []
    depth, keys, parent, chars, opener, last = [], [], [], [], [], []
    stack: list[int] = []
    chain: list[bytes] = []
    for prefix, seq, n, conv, lengths, *below in rows:
        shared = _common_turns(seq, seqs[-1]) if prefixes and prefixes[-1] == prefix else -1
        del stack[shared + 1:], chain[shared + 1:]
        for d in range(shared + 1, len(lengths) + 1):
            chain.append(_key(chain[-1] + seq[(d - 1) * WIDTH:d * WIDTH]) if d else b"")
            parent.append(stack[-1] if d else -1)
            stack.append(len(depth))
            depth.append(d)
            keys.append(prefix if level and not d else _key(prefix + chain[-1]))
            chars.append(lengths[d - 1] if d else 0)
            opener.append(len(seqs))
        prefixes.append(prefix)
        seqs.append(seq)
        convs.append(n)
        least.append(conv)
        hung.append(below)
        last.append(stack[-1])
    if not depth:
        return
    tree = Parentheses(np.array(depth))
    n, parent, chars, last = len(depth), np.array(parent), np.array(chars, dtype=np.int64), np.array(last)
    children, leaves, saved = (np.zeros(n, dtype=np.int64) for _ in range(3))
    children[last], leaves[last], saved[last] = np.array(hung, dtype=np.int64).T
    first, behind = np.searchsorted(last, np.arange(n)), np.searchsorted(last, tree.end)  # the sequences that pass through a node
    running = np.concatenate([[0], np.cumsum(convs)])
    members = running[behind] - running[first]
    smallest = np.minimum.reduceat(np.append(least, 0), np.stack([first, behind], axis=1).ravel())[::2]
    spine = (np.arange(n) <= last[0]) | (tree.end == n)  # what a neighbouring shard may hold too
    extra = leaves - (tree.is_leaf & (spine | (children > 0)))
    n_leaves = tree.leaf_pairs() + tree.below(extra)
    n_saved = tree.below(np.where(spine, 0, (members - 1) * chars) + saved)
    own = parent[~spine]
    n_children = children + np.bincount(own[own >= 0], minlength=n)
    columns = zip(depth, keys, parent.tolist(), spine.tolist(), members.tolist(), smallest.tolist(), n_children.tolist(), n_leaves.tolist(), n_saved.tolist())
    for j, (d, key, p, shared, m, conv, c, v, s) in enumerate(columns):
        up = None if p < 0 else keys[p]
        if shared:
            i = opener[j]
            yield SPINE, key, up, int(chars[j]), prefixes[i], seqs[i][:d * WIDTH], conv, level * longest + d, None, m, c, v, s
        elif level and not d:
            yield ROOT, key, None, 0, None, None, conv, level * longest, None, m, c, v, s
        else:
            known = not spine[p] and not (level and d == 1)
            yield DONE, key, None if known else up, 0, None, None, conv, level * longest + d, int(smallest[p]) if known else None, m, c, v, s


def _spines(rows: Iterator[tuple], level: int) -> Iterator[tuple]:
    """Values of the merged spine nodes, sorted by (prefix, path): theirs over the shards, and those of the spine nodes below them."""
    rows = list(rows)
    if not rows:
        return
    key, parent_key, chars, path, conv, depth, members, children, leaves, saved = zip(*rows)
    local = np.array([len(p) // WIDTH for p in path])
    tree = Parentheses(local)
    stack: list[int] = []
    parent = []
    for j, d in enumerate(local.tolist()):
        del stack[d:]
        parent.append(stack[-1] if stack else -1)
        stack.append(j)
    inner = np.array([p for p in parent if p >= 0], dtype=np.int64)
    n_children = np.array(children) + np.bincount(inner, minlength=len(rows))
    n_leaves = np.array(leaves) + tree.below((n_children == 0).astype(np.int64))
    n_saved = np.array(saved) + tree.below((np.array(members) - 1) * np.array(chars))
    for j, (d, p) in enumerate(zip(local.tolist(), parent)):
        root = bool(level) and d == 0
        known = p >= 0 and not (level and d == 1)
        yield (ROOT if root else DONE, key[j], None if known or root else parent_key[j], 0, None, None, conv[j], depth[j], conv[p] if known else None, members[j],
               int(n_children[j]), int(n_leaves[j]), int(n_saved[j]))


def turn_rows(df: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, digest, chars) of every turn: rows by turn, null first, ties by role and then by digest; nulls are empty.

    Rows are dealt by ranges, so a conversation may span tasks; the few that do get their places from counts per task.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    turns = df.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"),
        _key_of(F.length(role).cast("string"), F.lit(":"), role, text).alias("digest"), F.length(text).cast("bigint").alias("chars"))
    ordered = in_ranges(turns, [F.col("conv_id"), F.col("turn"), F.col("role"), F.col("digest")], tasks_for(df.count()))

    def work(rows: Iterator[tuple], task: int) -> Iterator[tuple]:
        at, place = None, 0
        for conv, digest, chars in rows:
            place = place + 1 if conv == at else 1
            at = conv
            yield conv, task, place, digest, chars

    schema = "conv_id bigint, part int, place bigint, digest binary, chars bigint"
    placed = write_and_read(arrow_rows(ordered.select("conv_id", "digest", "chars"), schema, work))
    parts = placed.groupBy("conv_id", "part").agg(F.max("place").alias("n")).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("p"))
    split = parts.filter(F.size("p") > 1).select("conv_id", F.posexplode("p").alias("i", "c"), "p")  # at most two rows a task
    before = split.select("conv_id", F.col("c.part").alias("part"), F.aggregate(F.slice("p", 1, F.col("i")), F.lit(0).cast("bigint"), lambda s, e: s + e.n).alias("before"))
    return placed.join(F.broadcast(before), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "chars")


def branches(turns: DataFrame, most: int = 6, group: int = 100) -> tuple[DataFrame, DataFrame]:
    """Conversations that continue another's beginning: the first h turns of conversation c - c % group, then c's own behind its first h;
    h is the CRC-32 of the decimal c, modulo ``most``.

    Gives rows (conv_id, pos, digest, chars) and all conversations (conv_id, total), those left without turns included.
    """
    turns = write_and_read(turns)
    head = F.col("conv_id") - F.col("conv_id") % group
    h = F.crc32(F.col("conv_id").cast("string")) % most
    firsts = turns.filter((F.col("conv_id") == head) & (F.col("pos") < most)).groupBy(F.col("conv_id").alias("head"))
    heads = few_or_hashed(write_and_read(firsts.agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("first"))))
    known = F.when(F.col("first").isNull(), 0).otherwise(F.size("first"))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own")).withColumns({"head": head, "h": h}).join(heads, "head", "left")
    convs = write_and_read(convs.select("conv_id", F.slice("first", 1, F.col("h").cast("int")).alias("first"),
                                        (F.least("h", known) + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("total")))
    own = turns.withColumns({"head": head, "h": h}).filter(F.col("pos") > F.col("h")).join(heads, "head", "left")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.least("h", known)).alias("pos"), "digest", "chars")
    begun = convs.select("conv_id", F.explode("first").alias("t")).select("conv_id", "t.pos", "t.digest", "t.chars")
    return own.unionByName(begun), convs.select("conv_id", "total")


def _cuts(rows: DataFrame, convs: DataFrame, longest: int) -> DataFrame:
    """(conv_id, level, prefix, seq, chars, chain, last): every conversation in cuts of at most ``longest`` turns."""
    level = F.floor((F.col("pos") - 1) / longest).cast("int")
    grouped = rows.groupBy("conv_id", level.alias("level")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("t"))
    grouped = grouped.select("conv_id", "level", F.col("t.digest").alias("digests"), F.col("t.chars").alias("chars"))
    schema = "conv_id bigint, level int, seq binary, chars array<bigint>, chain binary"

    def work(found: Iterator[tuple], task: int) -> Iterator[tuple]:
        for conv, lv, digests, chars in found:
            chain = b""
            for d in digests:
                chain = _key(chain + d)
            yield conv, lv, b"".join(digests), chars, chain

    none = F.lit(b"")
    silent = convs.filter("total = 0").select("conv_id", F.lit(0).alias("level"), none.alias("seq"), F.array().cast("array<bigint>").alias("chars"), none.alias("chain"))
    cuts = write_and_read(arrow_rows(grouped, schema, work).unionByName(silent))
    long = convs.filter(F.col("total") > longest).select("conv_id")
    if long.isEmpty():
        return cuts.withColumns({"prefix": none, "last": F.lit(True)})

    def lead(found: Iterator[tuple], task: int) -> Iterator[tuple]:
        for conv, chains in found:
            prefix = b""
            for i, c in enumerate(chains):
                yield conv, c["level"], prefix, i == len(chains) - 1
                prefix = _key(prefix + c["chain"])

    listed = cuts.join(few_or_hashed(write_and_read(long)), "conv_id", "left_semi").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("level", "chain"))).alias("chains"))
    leads = write_and_read(arrow_rows(listed, "conv_id bigint, level int, prefix binary, last boolean", lead))
    joined = cuts.join(few_or_hashed(leads), ["conv_id", "level"], "left")
    return joined.withColumns({"prefix": F.coalesce("prefix", none), "last": F.coalesce("last", F.lit(True))})


def prefix_trie(rows: DataFrame, convs: DataFrame, longest: int = LONGEST, turns_per_task: int = TURNS_PER_TASK) -> DataFrame:
    """All nodes of the trie of the conversations' turns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    ``rows`` are turns (conv_id, pos without gaps from 1, digest, chars), ``convs`` all conversations (conv_id, total turns); each has
    one row per conv_id. No conversations give no rows. Digests have 128 bits, and equal digests count as equal turns.
    """
    made: list[str] = []
    cuts = write_and_read(_cuts(rows, convs, longest), made)
    most = cuts.agg(F.max("level")).first()[0]
    spark = rows.sparkSession
    if most is None:
        return spark.createDataFrame([], f"{NODE}, ends_sha256 string")
    hung: DataFrame | None = None
    nodes: list[DataFrame] = []
    merged: list[DataFrame] = []
    for level in range(most, -1, -1):
        distinct = cuts.filter(F.col("level") == level).groupBy("prefix", "seq").agg(
            F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("chars").alias("chars"), F.first("chain").alias("chain"))
        if hung is None:
            distinct = distinct.withColumns({c: F.lit(0).cast("bigint") for c in ("n_children", "n_leaves", "saved_tokens")})
        else:
            full = F.when(F.size("chars") == longest, _key_of(F.col("prefix"), F.col("chain")))
            distinct = distinct.withColumn("key", full).join(few_or_hashed(hung), "key", "left").fillna(0, ["n_children", "n_leaves", "saved_tokens"])
        distinct = write_and_read(distinct.select("prefix", "seq", "n", "conv_id", "chars", "n_children", "n_leaves", "saved_tokens"), made)
        turns = distinct.agg(F.sum(F.size("chars") + 1)).first()[0]
        shards = in_ranges(distinct, [F.col("prefix"), F.col("seq")], max(8, 1 + turns // turns_per_task))
        found = write_and_read(arrow_rows(shards, FOUND, lambda r, _, lv=level: _shard(r, lv, longest), lambda r: len(r[5] or b"")), made)
        same = [F.first(c).alias(c) for c in ("key", "parent_key", "chars")]
        totals = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
        spine = found.filter(F.col("kind") == SPINE).groupBy("prefix", "path").agg(*same, F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), *totals)
        # two paths a shard, of at most `longest` turns each: one small task
        spine = spine.repartition(1).sortWithinPartitions("prefix", "path").select(
            "key", "parent_key", "chars", "path", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")
        spine = write_and_read(arrow_rows(spine, FOUND, lambda r, _, lv=level: _spines(r, lv)), made)
        merged.append(spine)
        nodes += [found.filter(F.col("kind") == DONE), spine.filter(F.col("kind") == DONE)]
        roots = found.filter(F.col("kind") == ROOT).unionByName(spine.filter(F.col("kind") == ROOT))
        hung = roots.select("key", "n_children", "n_leaves", "saved_tokens") if level else None

    everything = nodes[0]
    for more in nodes[1:]:
        everything = everything.unionByName(more)
    lookup = merged[0]
    for more in merged[1:]:
        lookup = lookup.unionByName(more)
    parents = lookup.filter(F.col("kind") == DONE)
    if most:  # cuts hang below nodes that need not be on a spine
        parents = parents.unionByName(everything.filter((F.col("depth") > 0) & (F.col("depth") % longest == 0))).dropDuplicates(["key"])
    parents = few_or_hashed(write_and_read(parents.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up")), made))
    ends = cuts.filter("last").select(_key_of(F.col("prefix"), F.col("chain")).alias("key"), "conv_id")
    tasks = tasks_for(ends.count())
    digests = hashed_in_order(pieces_of(write_and_read(ends, made), "key", "conv_id", tasks), "key", {"text": ","}, tasks)
    out = everything.join(parents, "parent_key", "left").join(digests, "key", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("text_sha256", F.lit(NOTHING)).alias("ends_sha256"))
    out = write_and_read(out)
    remove_dirs(spark, made)
    return out
