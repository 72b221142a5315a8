"""Truncated SVD, latent similarity, fold-in and power iteration against numpy."""

import numpy as np

from coact.operators import factor as fc
from coact.operators import svd as sv
from conftest import from_dense

# The small matrix the reference inspects its SVD on.
BY_EYE = np.array([[0, 1, 0, 0, 0], [0, 0, 1, 1, 0], [0, 0, 1, 1, 0], [0, 2, .5, 0, 0]], dtype=float)


def _random_sparse(seed, shape=(12, 30)):
    rng = np.random.default_rng(seed)
    x = np.round(rng.random(shape) * 5) * (rng.random(shape) > 0.6)
    x[x.sum(axis=1) == 0, 0] = 1.0
    return x


def test_gram_route_matches_numpy_svd(spark):
    x = _random_sparse(1)
    f = fc.truncated_svd(from_dense(spark, x), 5)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(f.s, s[:5])
    for d in range(5):
        assert np.isclose(abs(f.u[:, d] @ u[:, d]), 1.0)
        assert f.u[np.argmax(np.abs(f.u[:, d])), d] > 0          # sign convention


def test_by_eye_matrix(spark):
    f = fc.truncated_svd(from_dense(spark, BY_EYE), 2)
    assert np.allclose(f.s, np.linalg.svd(BY_EYE, compute_uv=False)[:2])


def test_energy_is_frobenius(spark):
    x = _random_sparse(2)
    f = fc.truncated_svd(from_dense(spark, x), None)
    assert np.isclose(f.energy(), np.sum(x ** 2))


def test_mllib_svd_agrees(spark):
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.linalg.distributed import RowMatrix
    x = _random_sparse(3, (8, 40))
    f = fc.truncated_svd(from_dense(spark, x), 3)
    m = RowMatrix(spark.sparkContext.parallelize([Vectors.dense(c) for c in x.T])).computeSVD(3)
    assert np.allclose(f.s, m.s.toArray(), rtol=1e-6)
    assert np.allclose(np.abs(np.diagonal(f.u.T @ m.V.toArray())), 1.0, atol=1e-6)


def test_panels_restarts_and_locking(spark, monkeypatch):
    """Several panels, a small basis that restarts often, and a flat spectrum."""
    monkeypatch.setattr(sv, "PANEL_ROWS", 64)
    monkeypatch.setattr(fc, "PANEL_ROWS", 64)
    monkeypatch.setattr(sv, "MIN_WIDTH", 16)
    monkeypatch.setattr(sv, "BASIS_COLUMNS", 100)
    rng = np.random.default_rng(11)
    n = 150
    u, v = np.linalg.qr(rng.standard_normal((n, n)))[0], np.linalg.qr(rng.standard_normal((n, n)))[0]
    s = np.linspace(1.0, 0.5, n)
    f = fc.truncated_svd(from_dense(spark, (u * s) @ v.T), 6)
    assert np.allclose(f.s, s[:6], rtol=1e-9)
    assert np.allclose(f.u.T @ f.u, np.eye(6), atol=1e-9)
    assert np.allclose(np.abs(np.diagonal(f.u.T @ u[:, :6])), 1.0, atol=1e-6)
    long = fc.factors_long(spark, f, 0.5).collect()
    got = np.zeros((n, 6))
    for r in long:
        got[r.i, r.d] = r.u
    assert np.allclose(got, f.latent(0.5))


def test_latent_similarity_topk_brute_force(spark):
    x = _random_sparse(4)
    f = fc.truncated_svd(from_dense(spark, x), 4)
    lat = f.latent()
    sim = lat @ lat.T
    n = np.sqrt(np.abs(np.diagonal(sim)))
    sim = sim / n[:, None] / n[None, :]
    got = fc.latent_similarity_topk(spark, f, 3).collect()
    for i in range(12):
        row = sim[i].copy()
        row[i] = -np.inf
        want = list(np.lexsort((np.arange(12), -np.round(row, 9)))[:3])
        mine = [r.j for r in sorted((r for r in got if r.i == i), key=lambda r: r.rk)]
        assert mine == want


def test_fold_in_reproduces_training_rows(spark):
    x = _random_sparse(5)
    f = fc.truncated_svd(from_dense(spark, x), None)
    entries = from_dense(spark, x).selectExpr("j as row", "i", "value")
    folded = fc.fold_in(entries, fc.factors_long(spark, f, scale_power=-1.0)).collect()
    v = np.zeros((x.shape[1], f.k))
    for r in folded:
        v[r.row, r.d] = r.value
    # A = U s V^T  =>  V = A^T U s^-1
    assert np.allclose(f.u @ np.diag(f.s) @ v.T, x, atol=1e-8)


def test_power_iteration_leading_value(spark):
    x = _random_sparse(6)
    got = fc.leading_singular_value(from_dense(spark, x), epsilon=1e-12).first()
    assert got.converged
    assert np.isclose(got.sigma, np.linalg.svd(x, compute_uv=False)[0], rtol=1e-5)


def test_rank_by_cosine(spark):
    rng = np.random.default_rng(8)
    e = rng.random((6, 4))
    df = spark.createDataFrame([(i, [float(v) for v in e[i]]) for i in range(6)], "id long, e array<double>")
    got = {r.id: r.sim for r in fc.rank_by_cosine(df, "id", "e", 2).collect()}
    want = e @ e[2] / np.linalg.norm(e, axis=1) / np.linalg.norm(e[2])
    assert np.allclose([got[i] for i in range(6)], np.round(want, 6))


def test_flat_spectrum_needs_few_passes(spark, monkeypatch):
    """The filter's products have no orthogonalisation between them: few blocks are factored."""
    monkeypatch.setattr(sv, "PANEL_ROWS", 64)
    monkeypatch.setattr(sv, "MIN_WIDTH", 16)
    monkeypatch.setattr(sv, "BASIS_COLUMNS", 40)
    blocks = []
    kind = getattr(sv, "Subspace", None) or sv.Krylov
    extend = kind.extend
    monkeypatch.setattr(kind, "extend", lambda self, q: blocks.append(q.shape[1]) or extend(self, q))
    rng = np.random.default_rng(5)
    u, v = (np.linalg.qr(rng.standard_normal((150, 150)))[0] for _ in range(2))
    s = np.sqrt(np.concatenate([[30.0], np.linspace(1, 0.4, 149)]))
    dense = (u * s) @ v.T
    _, panels, got = sv.block_svd(from_dense(spark, dense), 10)
    assert np.allclose(got, s[:10], rtol=1e-9)
    assert len(blocks) <= 16 and max(blocks) <= 40
    out = np.vstack([np.frombuffer(r.u).reshape(-1, 10) for r in panels.orderBy("p").collect()])
    assert np.allclose(np.abs((u[:, :10] * out).sum(axis=0)), 1, atol=1e-7)
