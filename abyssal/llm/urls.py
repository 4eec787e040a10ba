"""URL filters: rules looked up in a Bloom filter cascade.

A rule is a host and a path prefix written as one string (``example.net/en/``) in the block or the allow list. The keys of a URL
are its host and all parent domains, each with every prefix of its path that is as long as some rule's path. For each list a cascade is built over all keys of the corpus: level 1 encodes the listed keys, level 2 the keys outside
the list that level 1 lets through, level 3 the listed keys that level 2 lets through, and so on until a level lets none through.
The first level that refuses a key says whether it is listed: odd levels refuse what is not listed, even levels what is. Over the
keys it was built on, membership is exact, and probing needs no join.

Levels shrink by the false positive rate, so a cascade holds a few bits for each listed key whatever the corpus. It is a literal
in the plan; `MAX_KEYS` bounds it (longer lists are to be split over several cascades).

A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed. Repeated pages are judged alike.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abyssal.functions.common import remove_dirs, write_and_read

HASHES = 5
BITS_PER_KEY = 12
MAX_KEYS = 1_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark or hash; A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def keys_of(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys that a rule whose path has one of the ``lengths`` could have."""
    labels = F.split(host, r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length(path))
    prefixes = F.transform(fitting, lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(hosts, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))


@dataclass(frozen=True)
class Level:
    """One Bloom filter; ``words`` holds its bits, 64 in each."""

    bits: int
    words: tuple[int, ...]
    seed: int

    def lets_through(self, key: Column) -> Column:
        words = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        found = F.lit(True)
        for i in range(HASHES):
            bit = _bit(key, i, self.seed, self.bits)
            found = found & (F.getbit(F.get(words, F.floor(bit / 64).cast("int")), (bit % 64).cast("int")) == 1)
        return found


def _bit(key: Column, i: int, seed: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(i), key), F.lit(bits).cast("bigint"))


def build_level(keys: DataFrame, seed: int) -> Level | None:
    """A filter of the keys, or None where there are none. Bits are or-ed by aggregation; only the filter reaches the driver."""
    n = keys.count()
    if n == 0:
        return None
    if n > MAX_KEYS:
        raise ValueError(f"{n} keys in one filter; split the list")
    size = -(-max(64, n * BITS_PER_KEY) // 64) * 64
    at = keys.select(F.explode(F.array(*[_bit(F.col("key"), i, seed, size) for i in range(HASHES)])).alias("b"))
    words = at.groupBy(F.floor(F.col("b") / 64).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("v")).collect()
    out = [0] * (size // 64)
    for r in words:
        out[r["w"]] = r["v"]
    return Level(size, tuple(out), seed)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def has(self, key: Column) -> Column:
        """Exact for the keys the cascade was built on."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            verdict = F.when(~self.levels[i].lets_through(key), F.lit(i % 2 == 1)).otherwise(verdict)
        return verdict


def build_cascade(universe: DataFrame, listed: list[str], seed: int) -> Cascade:
    """``universe``: all distinct keys that will be asked for, in a column key. Listed keys outside it are encoded too.

    The list is the configuration and the universe the corpus: of the latter only the keys that a level wrongly lets through are
    looked at again, a part that the rate of false positives keeps in proportion to the list.
    """
    spark = universe.sparkSession
    if not listed:
        return Cascade(())
    inside = spark.createDataFrame([(k,) for k in sorted(set(listed))], "key string")
    outside = universe.filter(~F.col("key").isin(sorted(set(listed))))
    levels: list[Level] = []
    while True:
        level = build_level(inside if len(levels) % 2 == 0 else outside, seed + len(levels))
        if level is None:
            return Cascade(tuple(levels))
        levels.append(level)
        if len(levels) % 2 == 1:
            outside = outside.filter(level.lets_through(F.col("key")))
        else:
            inside = inside.filter(level.lets_through(F.col("key")))


def judge(pages: DataFrame, block: list[str], allow: list[str], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per page: id, host, path, rule (the longest that fits, else null), verdict (allow or block; allow without a rule)."""
    spark: SparkSession = pages.sparkSession
    made: list[str] = []
    lengths = sorted({len(r) - r.index("/") for r in [*block, *allow]})
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("keys", keys_of(F.col("host"), F.col("path"), lengths))
    universe = write_and_read(rows.select(F.explode("keys").alias("key")).distinct(), made)
    blocked, allowed = build_cascade(universe, block, 0), build_cascade(universe, allow, 100)
    remove_dirs(spark, made)
    # the longest key that is in a list; of keys of equal length the last in order
    fits = F.filter("keys", lambda k: blocked.has(k) | allowed.has(k))
    best = F.array_max(F.transform(fits, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))["key"]
    ruled = rows.withColumn("rule", best)
    verdict = F.when(F.col("rule").isNull(), "allow").when(allowed.has(F.col("rule")), "allow").otherwise("block")
    return ruled.select(id_col, "host", "path", "rule", verdict.alias("verdict"))
