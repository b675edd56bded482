"""Whitening against numpy's eigenvectors and whole-number arithmetic, and its defined cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartsight.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def symmetric(kind, n=40):
    rng = np.random.default_rng(3)
    basis, _ = np.linalg.qr(rng.standard_normal((n, n)))
    values = {
        "spread": np.geomspace(1e6, 1e-2, n),
        "near": 1 + np.arange(n) * 1e-9,
        "equal": np.repeat([5.0, 2.0, 1.0, 0.5], n // 4),
        "identity": np.ones(n),
        "low rank": np.r_[np.arange(1.0, 8.0), np.zeros(n - 7)],
    }[kind]
    return np.diag(values) if kind == "identity" else (basis * values) @ basis.T


@pytest.mark.parametrize("kind", ["spread", "near", "equal", "identity", "low rank"])
def test_components_are_eigenvectors(kind):
    a = symmetric(kind)
    a = (a + a.T) / 2
    values, vectors = whitening.leading_components(a, 32)
    exact = np.linalg.eigvalsh(a)[::-1][:32]
    assert len(values) == (7 if kind == "low rank" else 32)
    size = np.abs(a).max()
    assert np.abs(values - exact[: len(values)]).max() < 1e-13 * size * len(a)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * size * len(a)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_small_matrices(n):
    a = np.diag(np.arange(1.0, n + 1)) + 0.1
    values, vectors = whitening.leading_components(a, 32)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1]) and np.allclose(a @ vectors, vectors * values)


def test_counts_of_eigenvalues():
    rng = np.random.default_rng(0)
    d, e = rng.standard_normal(30), rng.standard_normal(29)
    exact = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-4, 4, 50)
    assert (whitening.sturm_counts(d, e, at) == (exact[None] < at[:, None]).sum(axis=1)).all()


def test_products_are_exact():
    rng = np.random.default_rng(0)
    for size in (10, 1 << 24, 1 << 39):
        z = rng.integers(-size, size, (50, 4))
        exact = [[sum(int(a) * int(b) for a, b in zip(z[:, i], z[:, j])) for j in range(4)] for i in range(4)]
        assert whitening._products(z).tolist() == exact


def result(spark, df, components=32):
    model = whitening.fit(df, components=components)
    return model, whitening.whiten(df, model).collect(), whitening.identity_error(df, model)


@pytest.mark.parametrize("offset", [0.0, 1000.0])
def test_equals_numpy(spark, offset):
    rng = np.random.default_rng(1)
    c = (rng.standard_normal((700, 12)) @ rng.standard_normal((12, 12)) + offset).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], SCHEMA).repartition(5)
    model, rows, error = result(spark, df, 5)
    x = np.floor(64 * c.astype(np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    y = (n * x - sums) / n
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:5], vectors[:, ::-1][:, :5]
    assert model.n == n and model.sums == tuple(sums.tolist())
    assert np.allclose(model.explained, values / np.trace(v), rtol=1e-9)
    expected = y @ vectors / np.sqrt(values)
    found = np.array([r.whitened for r in sorted(rows, key=lambda r: r.vec_id)])
    sign = np.sign((found * expected).sum(axis=0))
    assert np.abs(found - sign * expected).max() < 1e-8
    assert {r.vec_id: r.deviation for r in rows} == {i: sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for i, row in enumerate(x)}
    w = found - found.mean(axis=0)
    assert error < 1e-8 and abs(error - np.abs(w.T @ w / n - np.eye(5)).max()) < 1e-10


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = whitening.op12_whitening(spark, folder).collect()
    vectors = [r.embedding for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert len(rows) == 32 * len(vectors) and {r.component for r in rows} == set(range(1, 33))
    assert {r.n for r in rows} == {len(vectors)} and len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-4
    shares = {r.component: r.explained for r in rows}
    x = np.floor(64 * np.array(vectors, np.float64)) + 1_000_000
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert all(math.isclose(shares[k + 1], values[k] / values.sum(), rel_tol=1e-6) for k in range(32))


def test_defined_cases(spark):
    good = [[float(i % 3), float(i % 5), 1.0] for i in range(30)]
    rows = [(i, v) for i, v in enumerate(good)] + [
        (100, None),
        (101, [1.0, None, 2.0]),
        (102, [1.0, float("nan"), 2.0]),
        (103, [1.0, float("inf"), 2.0]),
        (104, [1.0, 3e38, 2.0]),
        (105, [1.0, 2.0]),
        (106, []),
        (None, good[0]),
        (5, good[5]),
    ]
    clash = {c: F.lit(f"own {c}") for c in ("_carried", "_vector", "n", "v", "component")}
    df = spark.createDataFrame(rows, SCHEMA).withColumns({**clash, "whitened": F.lit("own")}).repartition(3)
    model, out, error = result(spark, df)
    assert sorted((r.vec_id for r in out), key=lambda x: (x is None, x)) == sorted([*range(30), 5]) + [None]
    assert {r["component"] for r in out} == {"own component"} and {len(r.whitened) for r in out} == {2}  # the third has no variance
    assert model.n == 32 and error < 1e-10
    assert {tuple(r.whitened) for r in out if r.vec_id == 5} == {tuple(r.whitened) for r in out if r.vec_id == 20}  # equal vectors


def test_without_variance_and_without_rows(spark, tmp_path):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], SCHEMA)
    model, out, error = result(spark, same)
    assert [(r.deviation, r.whitened) for r in out] == [(0, [])] * 3 and error == 0
    assert whitening.fit(same.where("false")) is None
    nothing = spark.createDataFrame([(1, [])], SCHEMA)
    model, out, error = result(spark, nothing)
    assert [(r.deviation, r.whitened) for r in out] == [(0, [])]
    for k, df in enumerate((same, same.where("false"), nothing)):
        df.write.parquet(f"{tmp_path}/{k}/embeddings.parquet")
        assert whitening.op12_whitening(spark, f"{tmp_path}/{k}").collect() == []
