import random
from collections import Counter

from abyssal.llm.lines import without_boilerplate

SCHEMA = "doc_id bigint, text string, source string"
BLANKS = " \t\n\r\v\f"


def brute(rows, least):
    sites = {}
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if line.strip(BLANKS):
                sites.setdefault(line.strip(BLANKS), set()).add(site)
    out = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not x.strip(BLANKS) or len(sites[x.strip(BLANKS)]) < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_against_brute_force(spark):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        lines = [rng.choice([f"menu {rng.randrange(30)}", f" menu {rng.randrange(9)}\t", f"text {i} {rng.random()}", "", "  "]) for _ in range(rng.randint(0, 12))]
        rows.append((i if i % 50 else None, "\n".join(lines), rng.choice([None, "null", *[f"s{k}" for k in range(rng.choice([3, 40]))]])))
    rows += [(1, None, "s1"), (1, "", None), (2, "\n\n", "s1"), (3, "x\n" * 20_000 + "menu 1", "s2"), (3, "x", "s2"), (3, "x", "s2")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for least in (2, 8, 30):
        got = without_boilerplate(docs, min_sites=least).collect()
        assert Counter((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in got) == brute(rows, least)
    assert without_boilerplate(docs.limit(0)).collect() == []
