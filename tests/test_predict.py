"""Split, bias and predictors against the dense numpy formulas."""

import numpy as np

from coact.operators import predict as pr
from coact.operators.similarity import cosine_similarity
from conftest import from_dense, to_dense


def _np_sim(x, eps=1e-9):
    s = x @ x.T + eps
    n = np.sqrt(np.diagonal(s))
    return s / n[:, None] / n[None, :]


def _dense_ratings(seed=0, shape=(7, 5)):
    rng = np.random.default_rng(seed)
    return np.round(rng.random(shape) * 4) + 1.0       # no zeros: sparse == dense


def test_split_three_per_user_disjoint(spark):
    rng = np.random.default_rng(2)
    r = np.round(rng.random((9, 8)) * 5) * (rng.random((9, 8)) > 0.3)
    df = from_dense(spark, r)
    train, test = pr.train_test_split(df)
    tr = {(x.i, x.j) for x in train.collect()}
    te = {(x.i, x.j) for x in test.collect()}
    assert not tr & te
    assert tr | te == {(i, j) for i, j in zip(*np.nonzero(r))}
    for i in range(9):
        assert sum(1 for (a, _) in te if a == i) == min(3, int(np.count_nonzero(r[i])))


def test_bias_corrected_user_and_item(spark):
    r = _dense_ratings()
    df = from_dense(spark, r)
    su = _np_sim(r)
    ub = r.mean(axis=1)
    want_u = ub[:, None] + su @ (r - ub[:, None]) / np.abs(su).sum(axis=1)[:, None]
    got_u = to_dense(pr.predict_bias_corrected(df, pr.similarity_for(df, "user"), "user"), r.shape)
    assert np.allclose(got_u, want_u)
    si = _np_sim(r.T)
    ib = r.mean(axis=0)
    want_i = ib[None, :] + (r - ib[None, :]) @ si / np.abs(si).sum(axis=1)[None, :]
    got_i = to_dense(pr.predict_bias_corrected(df, pr.similarity_for(df, "item"), "item"), r.shape)
    assert np.allclose(got_i, want_i)


def test_topk_user(spark):
    r = _dense_ratings(1)
    df = from_dense(spark, r)
    s = _np_sim(r)
    k = 3
    want = np.zeros(r.shape)
    for i in range(r.shape[0]):
        nb = np.argsort(-s[:, i], kind="stable")[:k]
        want[i] = s[i, nb] @ r[nb] / np.abs(s[i, nb]).sum()
    got = to_dense(pr.predict_topk(df, pr.similarity_for(df, "user"), "user", k), r.shape)
    assert np.allclose(got, want)


def test_topk_item(spark):
    r = _dense_ratings(2)
    df = from_dense(spark, r)
    s = _np_sim(r.T)
    k = 2
    want = np.zeros(r.shape)
    for j in range(r.shape[1]):
        nb = np.argsort(-s[:, j], kind="stable")[:k]
        want[:, j] = r[:, nb] @ s[j, nb] / np.abs(s[j, nb]).sum()
    got = to_dense(pr.predict_topk(df, pr.similarity_for(df, "item"), "item", k), r.shape)
    assert np.allclose(got, want)


def test_means_include_zeros(spark):
    r = np.array([[1.0, 0.0, 3.0], [0.0, 0.0, 2.0]])
    df = from_dense(spark, r)
    assert {x.i: x.value for x in pr.row_means(df).collect()} == {0: 4 / 3, 1: 2 / 3}
    assert {x.i: x.value for x in pr.col_means(df).collect()} == {0: 0.5, 2: 2.5}


def test_mse(spark):
    rng = np.random.default_rng(3)
    p, a = rng.random((4, 4)), np.round(rng.random((4, 4)) * 3)
    got = pr.mse(from_dense(spark, p), from_dense(spark, a)).first().mse
    mask = a != 0
    assert np.isclose(got, np.mean((p[mask] - a[mask]) ** 2))


def test_cosine_similarity_for_predictions_has_unit_diagonal(spark):
    df = from_dense(spark, _dense_ratings(4))
    s = cosine_similarity(df, epsilon=1e-9, include_diagonal=True)
    diag = [x.value for x in s.where("i = j").collect()]
    assert np.allclose(diag, 1.0)


def _np_topk(x, k):
    sim = _np_sim(x)
    out = np.zeros(x.shape)
    for u in range(len(x)):
        near = np.lexsort((np.arange(len(x)), -np.round(sim[u], 9)))[:k]
        out[u] = sim[u, near] @ x[near] / np.abs(sim[u, near]).sum()
    return out


def test_topk_sparse_signed(spark):
    """Neighbours without a common entry rank before negative ones."""
    small = np.array([[1.0, 0, 0], [-1, 5, 0], [0, 0, 1]])
    rng = np.random.default_rng(5)
    large = np.round(rng.normal(size=(20, 15)) * 4) * (rng.random((20, 15)) < 0.15)
    large[np.arange(15), np.arange(15)] = 1.0
    large[15:, 0] = -2.0
    for x, k in ((small, 2), (large, 6)):
        df = from_dense(spark, x)
        got = to_dense(pr.predict_topk(df, pr.similarity_for(df, "user"), "user", k), x.shape)
        assert np.allclose(got, _np_topk(x, k), atol=1e-5)
        got = to_dense(pr.predict_topk(df, pr.similarity_for(df, "item"), "item", k), x.shape)
        assert np.allclose(got, _np_topk(x.T, k).T, atol=1e-5)
