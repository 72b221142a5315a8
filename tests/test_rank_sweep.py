"""The sweep covers every rank that the reference tries."""

import os

import numpy as np
import pytest

from coact.operators import factor as fc
from coact.plans import catalog as cat
from coact.plans import lsa

SF = "/root/testdata/sf0.01"
TRIED = {2, 3, 75, 90, 100, 150, 200, 300, 470, 500}     # batch/svd.py:88,100, testing.ipynb.py:562-702

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_sweep_against_numpy(spark):
    """100 items: the ranks up to 100."""
    cells = lsa.weighted_matrix(cat.lsa_model(spark, SF)).toPandas()
    x = np.zeros((cells.i.max() + 1, cells.j.max() + 1))
    np.add.at(x, (cells.i, cells.j), cells.value)
    s2 = np.linalg.svd(x, compute_uv=False) ** 2
    got = {r.k: r for r in cat.q_svd_rank_sweep(spark, SF).collect()}
    assert {k for k in TRIED if k <= len(s2)} <= got.keys() and max(got) <= len(s2)
    for k, r in got.items():
        assert np.isclose(r.energy, s2[:k].sum()) and np.isclose(r.fraction, s2[:k].sum() / s2.sum())


def test_ranks_above_the_batch_rank_and_a_matrix_of_lower_rank(spark, monkeypatch):
    """600 items of rank 400: the rows go on to 500."""
    values = np.sqrt(np.arange(400, 0, -1.0))
    monkeypatch.setattr(cat, "lsa_factors", lambda spark, sf_dir, rank=lsa.LSA_RANK: fc.Factors(
        np.arange(600), None, values[:rank]))
    monkeypatch.setattr(fc, "energy", lambda a: float(np.sum(values ** 2)))
    got = {r.k: r.energy for r in cat.q_svd_rank_sweep(spark, SF).collect()}
    assert TRIED <= got.keys()
    assert got[300] == np.sum(values[:300] ** 2) < got[470] == got[500] == np.sum(values ** 2)
