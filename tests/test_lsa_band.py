"""The LSA keys work on the reference's band and rank, not on a smaller one."""

import os

import numpy as np
import pytest

from coact.operators import factor as fc
from coact.plans import catalog as cat
from coact.plans import lsa
from conftest import from_dense

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_lsa_keys_use_the_reference_band_and_rank(spark):
    md = cat.lsa_model(spark, SF)
    assert md.band == lsa.LSA_BAND
    items = md.item_names.count()
    dims = cat.q_lsa_batch(spark, SF).agg({"dims": "max"}).first()[0]
    assert dims == min(lsa.LSA_RANK, items) == cat.lsa_factors(spark, SF).k


def test_fold_in_vectors_equals_dense_product(spark):
    x = np.round(np.random.default_rng(3).random((6, 15)) * 5) + np.eye(6, 15)
    f = fc.truncated_svd(from_dense(spark, x), 4)
    got = {r.row: r.vector for r in fc.fold_in_vectors(
        spark, from_dense(spark, x).selectExpr("j as row", "i", "value"), f, -0.5).collect()}
    want = x.T @ f.u * f.s ** -0.5
    assert np.allclose([got[j] for j in range(15)], want)


def test_one_route_whatever_the_item_bound(spark):
    """More items than the basis holds: restarts; a bound above 5,000 and full rank work."""
    x = np.round(np.random.default_rng(4).random((120, 200)) * 5) * (np.random.default_rng(5).random((120, 200)) > 0.8)
    a = from_dense(spark, x)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    f = fc.truncated_svd(a, 3)
    assert np.allclose(f.s, s[:3], rtol=1e-9) and np.allclose(np.abs(np.diagonal(f.u.T @ u[:, :3])), 1.0)
    full = fc.truncated_svd(a, None)
    assert full.k == 120 and np.allclose(full.s, s)
    assert np.isclose(fc.energy(a), np.sum(x ** 2)) and np.isclose(full.energy(), np.sum(x ** 2))


def test_missing_factors_are_told(spark):
    with pytest.warns(UserWarning, match="rank 1"):
        assert fc.truncated_svd(from_dense(spark, np.ones((3, 4))), 2).k == 1
