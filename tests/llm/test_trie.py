import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest

from abyssal.llm.trie import Parentheses, branches, prefix_trie, turn_rows

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def nodes(sequences):
    """Brute force: {path: row} over {conv_id: [(role, text), ...]}."""
    members = defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    out = []
    for path, convs in members.items():
        subtree = [p for p in members if p[:len(path)] == path]
        ends = ",".join(map(str, sorted(c for c in convs if len(sequences[c]) == len(path))))
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children[path], sum(not children[p] for p in subtree),
                    sum((len(members[p]) - 1) * len(p[-1][1]) for p in subtree if p), sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, role, sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16], text))
    own = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        head, h = c - int(np.fmod(c, 100)), zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(head, [])[:h] + turns[h:]
    return out


def rows_of(df):
    return sorted([(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()], key=repr)


def sample(seed, convs, longest, alphabet):
    rng = np.random.default_rng(seed)
    return [(int(c), int(t), ["user", "assistant"][t % 2], "x" * int(rng.integers(0, alphabet))) for c in convs for t in range(int(rng.integers(0, longest)))]


@pytest.mark.parametrize("longest,per_task", [(256, 40), (3, 60)])
def test_against_brute_force(spark, longest, per_task):
    rows = sample(longest, [*range(0, 260), *range(-130, -90), 1000, 1001], 9, 3)
    # one conversation is said by many, and one is much longer than the others
    rows += [(c, t, "user", "common") for c in range(2000, 2120) for t in range(4)] + [(300, t, "user", str(t % 2)) for t in range(23)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = prefix_trie(*branches(turn_rows(df)), longest=longest, turns_per_task=per_task)
    assert rows_of(got) == nodes(rebuilt(rows))


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    from abyssal.llm import sequences

    monkeypatch.setattr(sequences, "ROWS_PER_TASK", 20)
    rows = [(5, t // 3, "user", str(t % 7)) for t in range(400)] + [(6, t, "user", "0") for t in range(9)]
    found = sorted((r.conv_id, r.pos) for r in turn_rows(spark.createDataFrame(rows, SCHEMA)).collect())
    assert found == [(5, i + 1) for i in range(400)] + [(6, i + 1) for i in range(9)]
    assert rows_of(prefix_trie(*branches(turn_rows(spark.createDataFrame(rows, SCHEMA))), longest=50)) == nodes(rebuilt(rows))


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 5, "a", "é日"), (1, 5, "a", "é日"), (1, 5, "b", None), (2, 1, "", ""), (None, 1, "user", "no id"), (7, 1, "u", "t" * 300_000), (0, 2, "", ""), (0, None, "", "")]
    wide = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", pos int, key string")
    assert rows_of(prefix_trie(*branches(turn_rows(wide)))) == nodes(rebuilt(rows))
    assert prefix_trie(*branches(turn_rows(wide.limit(0)))).collect() == []
    alone = wide.filter("conv_id = 2")  # its one turn falls away, nothing comes instead: a turnless member of the root
    assert rows_of(prefix_trie(*branches(turn_rows(alone)))) == nodes(rebuilt([r for r in rows if r[0] == 2]))


@pytest.mark.parametrize("seed", range(6))
def test_parentheses(seed):
    rng = np.random.default_rng(seed)
    depth = [0]
    for _ in range(int(rng.integers(0, 3000))):
        depth.append(int(rng.integers(0, depth[-1] + 2)) if rng.random() < 0.3 else depth[-1] + 1 if rng.random() < 0.5 else max(depth[-1] - int(rng.integers(0, 90)), 0))
    tree = Parentheses(np.array(depth))
    end = [next((k for k in range(j + 1, len(depth)) if depth[k] <= d), len(depth)) for j, d in enumerate(depth)]
    leaf = [j + 1 == e for j, e in enumerate(end)]
    assert tree.end.tolist() == end and tree.is_leaf.tolist() == leaf
    assert tree.leaf_pairs().tolist() == [sum(leaf[j:e]) for j, e in enumerate(end)]
    values = rng.integers(0, 9, len(depth))
    assert tree.below(values).tolist() == [int(values[j:e].sum()) for j, e in enumerate(end)]
