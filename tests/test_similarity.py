"""Cosine similarity and top-k against a numpy brute force."""

import numpy as np

from coact.operators.similarity import cosine_similarity, top_k_per_row
from conftest import from_dense, to_dense


def _np_cosine(x, eps=0.0):
    sim = x @ x.T + eps
    n = np.sqrt(np.diagonal(sim))
    return sim / n[:, None] / n[None, :]


def test_cosine_dense_random(spark):
    rng = np.random.default_rng(3)
    x = rng.random((5, 6))
    got = to_dense(cosine_similarity(from_dense(spark, x), include_diagonal=True), (5, 5))
    assert np.allclose(got, _np_cosine(x))


def test_cosine_is_symmetric_with_unit_diagonal(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.random((8, 12)) * 4) * (rng.random((8, 12)) > 0.5)
    x[x.sum(axis=1) == 0, 0] = 1
    s = to_dense(cosine_similarity(from_dense(spark, x), include_diagonal=True), (8, 8))
    assert np.allclose(s, s.T)
    assert np.allclose(np.diagonal(s), 1.0)


def test_cosine_columns_and_epsilon(spark):
    rng = np.random.default_rng(5)
    x = rng.random((4, 7))
    got = to_dense(cosine_similarity(from_dense(spark, x), axis="cols", epsilon=1e-9,
                                     include_diagonal=True), (7, 7))
    assert np.allclose(got, _np_cosine(x.T, 1e-9))


def test_top_k_per_row_orders_and_excludes_self(spark):
    rng = np.random.default_rng(6)
    x = rng.random((6, 9))
    sim = _np_cosine(x)
    names = spark.createDataFrame([(i, f"n{i}") for i in range(6)], "i long, item string")
    got = top_k_per_row(cosine_similarity(from_dense(spark, x)), 3, names=names).collect()
    for i in range(6):
        mine = sorted((r.rk, r.related) for r in got if r.item == f"n{i}")
        row = sim[i].copy()
        row[i] = -np.inf
        expect = [f"n{j}" for j in np.argsort(-row)[:3]]
        assert [n for _, n in mine] == expect


def test_top_k_ties_break_by_name(spark):
    from coact.operators import matrix as mx
    sim = mx.from_rows(spark, [(0, 1, 0.5), (0, 2, 0.5), (0, 3, 0.9)])
    names = spark.createDataFrame([(0, "a"), (1, "z"), (2, "b"), (3, "c")], "i long, item string")
    got = [r.related for r in top_k_per_row(sim, 3, names=names).orderBy("rk").collect()]
    assert got == ["c", "b", "z"]


def test_salted_block_self_join_matches_plain(spark):
    """A hot column split into many salted blocks gives exactly the plain pair dots."""
    from coact.operators.similarity import pair_dots
    rng = np.random.default_rng(9)
    x = np.round(rng.random((60, 4)) * 3)
    x[:, 0] = rng.integers(1, 4, size=60)          # column 0 is hot: every row has it
    m = from_dense(spark, x)
    plain = {(r.a, r.b): r.dot for r in pair_dots(m).collect()}
    salted = {(r.a, r.b): r.dot for r in pair_dots(m, block=7, key_bound=4).collect()}
    assert plain == salted
    got = to_dense(cosine_similarity(m, block=7, key_bound=4, include_diagonal=True), (60, 60))
    assert np.allclose(got, _np_cosine(x))


def test_cosine_rows_lists_rows_without_overlap(spark):
    from coact.operators.similarity import cosine_rows
    x = np.array([[1, 2, 0, 0], [0, 0, 3, 0], [0, -1, 1, 0], [0, 0, 0, 0], [2, 0, 0, 5.0]])
    req = spark.createDataFrame([(0,), (0,), (2,), (3,), (99,)], "i long")
    got = {(r.i, r.j): r.value for r in cosine_rows(from_dense(spark, x), req, 5, 0.5).collect()}
    dot, norm = x @ x.T + 0.5, np.sqrt((x ** 2).sum(1) + 0.5)
    want = {(i, j): dot[i, j] / norm[i] / norm[j] for i in (0, 2) for j in (0, 1, 2, 4) if i != j}
    assert got.keys() == want.keys() and all(np.isclose(got[k], want[k]) for k in want)
