"""Whitening against an eigendecomposition with exact integer centring."""

import numpy as np
import pytest

from revenue_engine.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(object) + 100_000
    x = np.array([[int(t) for t in r] for r in x], object)
    n, s = len(x), x.sum(axis=0)
    spread = n * x - s
    a = (spread / n).astype(np.float64)
    e, u = np.linalg.eigh(a.T @ a / n)
    e, u = e[::-1], u[:, ::-1]
    return [int((r * r).sum()) for r in spread], e, (a @ u) / np.sqrt(np.maximum(e, 1e-300)), e / e.sum()


def result(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return wh.whiten(df, **kw).collect()


def check(spark, vectors, wanted=8):
    got = result(spark, [(i, [float(c) for c in v]) for i, v in enumerate(vectors)], wanted=wanted)
    dev, e, white, share = brute(np.array(vectors, np.float32))
    k = min(wanted, int((e > 1e-9 * e[0]).sum()))
    assert len(got) == k * len(vectors)
    y = np.zeros((len(vectors), k))
    for r in got:
        y[r["id"], r["component"] - 1] = r["whitened"]
        assert int(r["deviation"]) == dev[r["id"]] and r["n"] == len(vectors)
        assert r["explained"] == pytest.approx(share[r["component"] - 1], rel=1e-9)
        assert r["identity_error"] < 1e-8
    return y, white[:, :k]


def test_against_eigendecomposition(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((300, 12)) @ np.diag(np.linspace(3, 0.2, 12)) @ rng.standard_normal((12, 12)) / 4
    y, white = check(spark, vectors)
    for j in range(8):
        assert min(np.abs(y[:, j] - white[:, j]).max(), np.abs(y[:, j] + white[:, j]).max()) < 1e-7


def test_repeated_eigenvalues_are_all_found(spark):
    eye = np.eye(6)
    vectors = [s * eye[i] * (2 if i < 3 else 1) for i in range(6) for s in (1.0, -1.0) for _ in range(5)]
    y, _ = check(spark, vectors, wanted=6)  # three equal large deviations, three equal small ones
    assert np.abs(y.T @ y / len(vectors) - np.eye(6)).max() < 1e-9


def test_fewer_directions_than_wanted(spark):
    rng = np.random.default_rng(5)
    plane = rng.standard_normal((2, 10)).round(1)
    vectors = np.array([[int(a), int(b)] for a in range(-3, 4) for b in range(-3, 4)]) @ (plane * 1024).astype(int) / 1024.0
    check(spark, vectors)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [2.0, 1.0]), (None, [0.0, 0.5]), (2, None), (3, []), (4, [1.0, None]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [1.0, 2.0, 3.0]), (8, [0.0, 0.0])]
    got = result(spark, rows)
    assert {r["n"] for r in got} == {4}
    assert sorted((r["id"] is None, r["id"] or 0, r["component"]) for r in got) == sorted(
        (i is None, i or 0, c) for i in (1, 1, None, 8) for c in (1, 2))


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(i, [3.0, 1.0]) for i in range(4)], [(1, None)]])
def test_no_variance_no_rows(spark, rows):
    assert result(spark, rows) == []


def test_huge_entries_stay_exact(spark):
    rows = [(i, [float(v), 1.0 + i]) for i, v in enumerate((1e15, -1e15, 3e14, 5.0))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("vec_id", "embedding", "'z' as id", "1 as x")
    got = wh.whiten(df).collect()
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in rows]
    n, s = len(x), [sum(c) for c in zip(*x)]
    for r in got:
        assert int(r["deviation"]) == sum((n * c - t) ** 2 for c, t in zip(x[r["id"]], s))
