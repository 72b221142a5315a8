"""The two forms of the SVD's products, and how much work its steps are."""

import numpy as np
import pytest

from coact.operators import svd as sv
from conftest import from_dense


def _sparse(seed, shape=(90, 200), share=0.85):
    rng = np.random.default_rng(seed)
    x = np.round(rng.random(shape) * 5) * (rng.random(shape) > share)
    x[:, 0] = 1.0                                            # no empty item
    return x


def test_strips_sum_to_the_item_products(spark, monkeypatch):
    """Several strips, the last one shorter; user rows and pairs are handled in small parts."""
    monkeypatch.setattr(sv, "STRIP_CELLS", 700)
    monkeypatch.setattr(sv, "DEALT_ROWS", 20)
    monkeypatch.setattr(sv, "PAIRS", 64)
    x = _sparse(1)
    strips = {r.p: np.frombuffer(r.g).reshape(-1, 90) for r in
              sv.gram_strips(from_dense(spark, x), np.arange(90)).collect()}
    assert len(strips) > 4 and sorted(strips) == list(range(len(strips)))
    assert np.allclose(np.vstack([strips[p] for p in sorted(strips)]), x @ x.T)


def test_slots_are_dealt_one_to_a_partition(spark):
    from pyspark.sql import functions as F
    keys = [int(k) for k in sv._slots(spark, 13)]
    got = spark.createDataFrame([(k,) for k in keys], "k long").repartition(13, "k").select(F.spark_partition_id()).collect()
    assert sorted(r[0] for r in got) == list(range(13))


@pytest.mark.parametrize("ratio", [32, 0])
def test_both_products_give_the_same_factors(spark, monkeypatch, ratio):
    """Iterated, by strips (the cells are few) and by user rows (they are not); items have gaps in their ids."""
    monkeypatch.setattr(sv, "PANEL_ROWS", 32)
    monkeypatch.setattr(sv, "MIN_WIDTH", 16)
    monkeypatch.setattr(sv, "BASIS_COLUMNS", 40)
    monkeypatch.setattr(sv, "GRAM_RATIO", ratio)
    x = _sparse(2)
    a = from_dense(spark, x).selectExpr("i * 3 + 5 as i", "j", "value")
    index, panels, s = sv.block_svd(a, 8)
    u, want, _ = np.linalg.svd(x, full_matrices=False)
    assert list(index) == [i * 3 + 5 for i in range(90)] and np.allclose(s, want[:8], rtol=1e-9)
    got = np.vstack([np.frombuffer(r.u).reshape(-1, 8) for r in panels.orderBy("p").collect()])
    assert np.allclose(got.T @ got, np.eye(8), atol=1e-9)
    assert np.allclose(np.abs((u[:, :8] * got).sum(axis=0)), 1, atol=1e-6)


def test_repeated_values_have_all_their_vectors(spark, monkeypatch):
    """Equal blocks: each singular value comes several times."""
    monkeypatch.setattr(sv, "PANEL_ROWS", 32)
    monkeypatch.setattr(sv, "MIN_WIDTH", 16)
    monkeypatch.setattr(sv, "BASIS_COLUMNS", 40)
    x = np.kron(np.eye(4), _sparse(3, (30, 50), 0.5))
    _, panels, s = sv.block_svd(from_dense(spark, x), 12)
    got = np.vstack([np.frombuffer(r.u).reshape(-1, 12) for r in panels.orderBy("p").collect()])
    assert np.allclose(s, np.linalg.svd(x, compute_uv=False)[:12], rtol=1e-9)
    assert np.allclose(got.T @ got, np.eye(12), atol=1e-9)
    assert np.allclose(x @ (x.T @ got), got * s ** 2, atol=1e-6)


def test_a_low_rank_matrix_of_many_items(spark, monkeypatch):
    monkeypatch.setattr(sv, "PANEL_ROWS", 32)
    monkeypatch.setattr(sv, "MIN_WIDTH", 16)
    monkeypatch.setattr(sv, "BASIS_COLUMNS", 40)
    rng = np.random.default_rng(4)
    x = rng.random((90, 3)) @ rng.random((3, 60))
    with pytest.warns(UserWarning, match="rank 3"):
        _, _, s = sv.block_svd(from_dense(spark, x), 10)
    assert np.allclose(s, np.linalg.svd(x, compute_uv=False)[:3], rtol=1e-9)


def _jobs(spark, name, fn):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        fn()
    finally:
        sc._jsc.clearJobGroup()
    return len(sc.statusTracker().getJobIdsForGroup(name))


def test_a_step_is_few_jobs(spark, monkeypatch):
    """A product is one job; so is a factorisation. Few items need no iteration."""
    monkeypatch.setattr(sv, "MIN_WIDTH", 16)
    x = _sparse(5, (60, 80), 0.5)
    a = from_dense(spark, x).localCheckpoint()
    assert _jobs(spark, "svd few items", lambda: sv.block_svd(a, 10)) <= 14
    monkeypatch.setattr(sv, "BASIS_COLUMNS", 20)
    blocks = []
    extend = sv.Subspace.extend
    monkeypatch.setattr(sv.Subspace, "extend", lambda self, q: blocks.append(q) or extend(self, q))
    products = []
    if hasattr(sv.Subspace, "product"):
        product = sv.Subspace.product
        monkeypatch.setattr(sv.Subspace, "product", lambda self, q: products.append(q) or product(self, q))
    jobs = _jobs(spark, "svd iterated", lambda: sv.block_svd(a, 4))
    assert jobs <= 14 + len(products) + 2 * len(blocks)


def test_the_degree_is_no_more_than_the_residuals_need():
    assert sv.filter_degree(2.0, 1.0, 1.5, 10.0) == 3 < sv.filter_degree(2.0, 1.0)
    assert sv.filter_degree(2.0, 1.0, 1.0001, 1e30) == sv.filter_degree(2.0, 1.0)      # the growth is the bound
    assert 1 <= sv.filter_degree(1e9, 1.0, 1.5, 1e9) and sv.filter_degree(1.0, 1.0) <= sv.MAX_DEGREE
