import numpy as np
import pytest

from abyssal.llm.whitening import whiten


def brute(rows, components=4, counts=False):
    """{(id, component): (n, deviation, whitened, explained)} by plain numpy; the sign is left to the caller."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for d in {len(v) for _, v in kept}:
        x = {tuple(int(np.floor(256 * float(c))) for c in v): 0 for _, v in kept if len(v) == d}
        for _, v in kept:
            if len(v) == d:
                x[tuple(int(np.floor(256 * float(c))) for c in v)] += 1
        points = np.array(list(x), dtype=float)
        w = np.array(list(x.values()) if counts else [1] * len(x), dtype=float)
        n, s = int(w.sum()), (w[:, None] * points).sum(0)
        y = points - s / n
        values, vectors = np.linalg.eigh((w[:, None] * y).T @ y / n)
        for i, v in kept:
            if len(v) == d:
                q = np.floor(256 * np.array(v, dtype=float))
                for k in range(min(components, d)):
                    e, u = values[-1 - k], vectors[:, -1 - k]
                    out.append((i, k + 1, n, int(((n * q - s) ** 2).sum()), (q - s / n) @ u / np.sqrt(e), e / values.sum()))
    return sorted(out, key=lambda r: (r[0], r[1], r[3], abs(r[4])))


def compare(got, want):
    got = sorted([(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in got], key=lambda r: (r[0], r[1], r[3], abs(r[4])))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for k in {r[1] for r in want}:
        a = np.array([(r[4], r[5]) for r in got if r[1] == k])
        b = np.array([(r[4], r[5]) for r in want if r[1] == k])
        sign = np.sign(a[:, 0] @ b[:, 0])
        assert np.allclose(a[:, 0] * sign, b[:, 0], atol=1e-9) and np.allclose(a[:, 1], b[:, 1], rtol=1e-9)


@pytest.mark.parametrize("weights", ["one", "count"])
def test_against_brute_force(spark, weights):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 8)) * np.arange(1, 9) + 50.0
    base[200:] = base[0]  # a third of the rows are one vector
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(base)]
    got = whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5), weights=weights).collect()
    compare(got, brute(rows, counts=weights == "count"))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_common_vectors_join_by_broadcast(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [float(c) for c in rng.normal(size=3)]) for i in range(3000)]
    got = whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), components=2).collect()
    compare(got, brute(rows, components=2))


def test_far_from_the_origin(spark):
    """Centring comes before multiplying: an offset of a million changes nothing."""
    rng = np.random.default_rng(5)
    near = np.floor(rng.normal(size=(200, 5)) * [9, 7, 5, 3, 1] * 256) / 256
    far = near + 2.0**20
    sets = [whiten(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id int, embedding array<double>"), components=5).collect() for x in (near, far)]
    a, b = (np.array([r.whitened for r in sorted(s, key=lambda r: (r.vec_id, r.component))]).reshape(-1, 5) for s in sets)
    assert np.allclose(np.abs(a), np.abs(b), atol=1e-10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [-0.001, 5.0]), (2, [-0.001, 5.0]), (3, None), (4, []), (5, [1.0, None]), (6, [nan, 1.0]), (7, [1.0, -inf]), (8, [3.0]), (9, [4.0]),
            (10, [1e30, 0.0]), (None, [2.0, 2.0])]
    vectors = spark.createDataFrame([(*r, 1, "n") for r in rows], "vec_id bigint, embedding array<double>, n int, x string")
    got = whiten(vectors).collect()
    assert sorted((r.vec_id or 0, r.component, r.n) for r in got) == [(0, 1, 3), (0, 2, 3), (1, 1, 3), (1, 2, 3), (2, 1, 3), (2, 1, 3), (2, 2, 3), (2, 2, 3), (8, 1, 2), (9, 1, 2)]
    compare([r for r in got if r.vec_id in (8, 9)], brute([(8, [3.0]), (9, [4.0])]))
    assert whiten(vectors.limit(0)).collect() == []


def test_nothing_varies(spark):
    got = whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id bigint, embedding array<float>")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, None, None, 0.0)] * 4
    line = whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], "vec_id bigint, embedding array<float>"), components=3).collect()
    assert {r.component: r.whitened is None for r in line} == {1: False, 2: True, 3: True} and line[0].identity_error < 1e-9


def test_large_entries_stay_exact(spark):
    big = 2.0**40
    got = whiten(spark.createDataFrame([(1, [big]), (2, [-big]), (3, [big / 2])], "vec_id bigint, embedding array<double>")).collect()
    x = {1: int(big) * 256, 2: -int(big) * 256, 3: int(big) * 128}
    s = sum(x.values())
    assert {r.vec_id: r.deviation for r in got} == {i: (d if (d := (3 * v - s) ** 2) < 2**63 else None) for i, v in x.items()}
