import random

from abyssal.llm.urls import build_cascade, judge
from pyspark.sql import functions as F

BLOCK, ALLOW = ["net/", "example.com/de/"], ["example.net/en/", "org/fr/"]
URLS = [None, "", "net/", "http://", "http://net", "http://net/", "https://a.NET/x", "http://internet/", "ftp://x.example.net/en/a?b#c", "http://example.net/en", "http://example.net/EN/",
        "http://a.example.com/de/q", "http://example.com/d", "http://b.org/fr/", "http://org/fr/x", "http://a.b.org?x=/fr/", "x://y://net/", "http://example.net./en/", "http://e.net#/en/", "http://a\nb.net/en/\n"]


def brute(url, block=BLOCK, allow=ALLOW):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = rest
        for c in "/?#":
            host = host.split(c)[0]
        path = rest[len(host):].split("?")[0].split("#")[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in block + allow:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best)):
            best = rule
    return host, path, best, "block" if best in block else "allow"


def test_against_brute_force(spark):
    rng = random.Random(4)
    urls = URLS + ["http://" + ".".join(rng.choice(["a", "example", "net", "com", "org", "NET"]) for _ in range(rng.randint(1, 4))) + rng.choice(["", "/", "/en/", "/de/x", "/fr/", "/EN/"]) for _ in range(300)]
    rows = [(i % 250, u, "extra") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    got = sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in judge(pages, BLOCK, ALLOW).collect())
    want = sorted((i, *brute(u)[:2], brute(u)[2] or "", brute(u)[3]) for i, u, _ in rows)
    assert got == want
    assert judge(pages.limit(0), BLOCK, ALLOW).collect() == []
    assert {r.verdict for r in judge(pages, [], []).collect()} == {"allow"}


def test_rules_whose_path_ends_anywhere(spark):
    block, allow = ["a.foo/bar", "foo/b", "net/é"], ["foo/bar/x.htm", "foo/"]
    urls = [f"http://{h}{p}" for h in ("foo", "a.foo", "b.a.foo", "net") for p in ("", "/", "/b", "/ba", "/bar", "/barn/x", "/bar/x.htm", "/bar/x.html?q", "/Bar", "/é", "/éa")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge(pages, block, allow).collect()}
    assert got == {i: brute(u, block, allow) for i, u in enumerate(urls)}


def test_cascade_is_exact_over_its_universe(spark):
    listed = [f"k{i}" for i in range(0, 6000, 3)]
    universe = spark.range(6000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    cascade = build_cascade(universe, listed, 7)
    assert len(cascade.levels) > 1
    got = {r.key for r in universe.filter(cascade.has(F.col("key"))).collect()}
    assert got == set(listed)
