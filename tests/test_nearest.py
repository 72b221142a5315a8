"""Exact top-k neighbours: every pair by brute force, popular columns, ties, edges."""

import random

import numpy as np
import pytest

from conftest import from_dense
from coact.operators import nearest as nn
from coact.operators.similarity import SIM_DIGITS


def brute(d, k):
    """Top k of each row by plain products, rounded, smaller id first."""
    norm = np.sqrt((d * d).sum(1))
    out = set()
    for i in np.nonzero(norm)[0]:
        hits = [(-round(float(d[i] @ d[j] / norm[i] / norm[j]), SIM_DIGITS) + 0.0, int(j))
                for j in np.nonzero(norm)[0] if j != i and ((d[i] != 0) & (d[j] != 0)).any()]
        out |= {(int(i), j, r + 1, -s + 0.0) for r, (s, j) in enumerate(sorted(hits)[:k])}
    return out


def rows(df):
    return {(r.i, r.j, r.rk, r.sim + 0.0) for r in df.collect()}


def skewed(n=260, items=40, seed=4):
    """Column 0 belongs to every row, column 1 to a third; copies and negative weights."""
    rng = random.Random(seed)
    d = np.zeros((n, items))
    for i in range(n):
        d[i, 0] = rng.choice([1, 1, 2, -1])
        if i % 3 == 0:
            d[i, 1] = rng.choice([1, -2, 3])
        for j in rng.sample(range(2, items), 5):
            d[i, j] = rng.choice([-3, -1, 1, 2, 5, 8])
    d[40:60] = d[40]                                    # ties: twenty equal rows
    return d


@pytest.mark.parametrize("k", [3, 300])
def test_equals_all_pairs(spark, k):
    d = skewed()
    got = nn.top_k_neighbours(from_dense(spark, d), k, share=10, floor=5)
    assert rows(got) == brute(d, k)


def test_columns_and_fewer_than_k(spark):
    d = np.zeros((6, 9))
    d[0, [0, 1]] = 2, -1
    d[1, [0, 2]] = -3, 1                                 # only a negative partner
    d[4, 7] = 5                                          # shares nothing: no rows
    assert rows(nn.top_k_neighbours(from_dense(spark, d), 4)) == brute(d, 4)
    assert rows(nn.top_k_neighbours(from_dense(spark, d.T), 4, axis="cols")) == brute(d, 4)


def test_repeated_zero_null_and_empty(spark):
    m = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (1, 0, 4.0), (2, 0, 0.0), (3, 1, 1.0), (4, 1, 1.0),
                               (4, 1, -1.0), (None, 0, 1.0), (5, None, 1.0)],
                              "i long, j long, value double")
    assert rows(nn.top_k_neighbours(m, 2)) == {(0, 1, 1, 1.0), (1, 0, 1, 1.0)}
    assert nn.top_k_neighbours(m.limit(0), 2).count() == 0
    with pytest.raises(ValueError):
        nn.top_k_neighbours(m, 0)


def test_popular_column_does_not_bring_all_pairs(spark):
    """Tight groups beside a column that everyone shares: most co-active pairs never meet."""
    rng = np.random.default_rng(1)
    d = np.zeros((400, 101))
    d[:, 0] = 1
    for i in range(400):
        d[i, 1 + i // 8 * 2:3 + i // 8 * 2] = rng.integers(4, 9, 2)
    e = nn.weighted_entries(from_dense(spark, d))
    least = nn.floors(e, 3)
    pairs = nn.candidates(e, least).count()
    assert pairs < 400 * 399 * 0.1                      # all 159,600 ordered pairs are co-active
    assert rows(nn.top_k_neighbours(from_dense(spark, d), 3)) == brute(d, 3)
    kth = {i: s for i, _, r, s in brute(d, 3) if r == 3}
    assert all(r.least <= kth[r.i] + 1e-9 for r in least.collect())
