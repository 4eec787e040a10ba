import numpy as np
import pytest

from abyssal.llm.covertree import near_duplicates


def brute(rows, cosine):
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    component = {}
    for i in range(len(ids)):
        if ids[i] in component:
            continue
        seen = stack = {i}
        stack = [i]
        seen = {i}
        while stack:
            for j in np.flatnonzero(linked[stack.pop()]):
                if j not in seen:
                    seen.add(int(j))
                    stack.append(int(j))
        for j in seen:
            component[ids[j]] = min(ids[k] for k in seen)
    return {i: (int(linked[k].sum()), component[i]) for k, i in enumerate(ids)}


def data(seed, n=600, d=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, d))
    spread = rng.choice([0.02, 0.1, 0.25, 0.4], size=n)
    rows = centres[rng.integers(0, 8, n)] + spread[:, None] * rng.normal(size=(n, d))
    rows[: n // 3] = rng.normal(size=(n // 3, d))
    return [(int(i), [float(c) for c in r * rng.uniform(0.1, 9)]) for i, r in zip(rng.permutation(10 * n)[:n], rows)]


@pytest.mark.parametrize("block", [4096, 60])
def test_against_brute_force(spark, block):
    rows = data(block)
    got = near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4), block=block).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows, 0.95)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (2, [2.0, 4.0, 6.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 3.0]), (6, [1.0, float("nan"), 3.0]), (7, [float("inf"), 2.0, 3.0]),
            (8, [1.0, 2.0]), (None, v), (9, v), (9, v), (10, [])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(vectors).collect()}
    alone = {i: (0, i, True) for i in (3, 4, 5, 6, 7, 8, 10)}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 9: (2, 1, False), None: (0, None, False)} | alone
    assert near_duplicates(vectors.limit(0)).collect() == []


def test_lengths_and_magnitudes(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0, 0.0]), (4, [1.0, 0.0, 0.0]), (5, [0.0, 0.0, 1.0]),
            (6, [1e200, 1e200, 0.0]), (7, [2e200, 2e200, 0.0]), (8, [1e-200, 0.0, 1e-200]), (9, [5e-324, 0.0, 5e-324]), (10, [7.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (1, 6), 7: (1, 6), 8: (1, 8), 9: (1, 8), 10: (0, 10)}
