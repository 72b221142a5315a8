"""Leading singular triple against numpy, and its edges."""

import numpy as np
import pytest

from conftest import from_dense
from coact.operators.bidiagonal import leading_triple
from coact.operators import factor as fc


def vec(df, key, n):
    out = np.zeros(n)
    for r in df.collect():
        out[r[key]] = r.value
    return out


def test_value_and_both_vectors(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(14, 30)) * 5) * (rng.random((14, 30)) > 0.5)
    x[4] = rng.integers(1, 6, 30)                        # one row holds much of the entries
    got = leading_triple(from_dense(spark, x))
    u, v = vec(got.u, "i", 14), vec(got.v, "j", 30)
    ref = np.linalg.svd(x)
    assert np.isclose(got.sigma, ref[1][0], rtol=1e-10)
    assert np.allclose(x @ v, got.sigma * u, atol=1e-8) and np.allclose(x.T @ u, got.sigma * v, atol=1e-8)
    assert np.isclose(u @ u, 1) and np.isclose(v @ v, 1) and u[np.argmax(np.abs(u))] > 0
    with pytest.raises(RuntimeError):
        leading_triple(from_dense(spark, x), max_steps=1)


def test_low_rank_empty_and_cancelled(spark):
    x = np.outer([1.0, 2, 2], [3.0, 0, 4])               # rank one: 3 * 5
    got = leading_triple(from_dense(spark, x))
    assert np.isclose(got.sigma, 15) and np.allclose(vec(got.u, "i", 3), [1 / 3, 2 / 3, 2 / 3])
    m = spark.createDataFrame([(0, 0, 2.0), (0, 0, -2.0)], "i long, j long, value double")
    for none in (leading_triple(m), leading_triple(m.limit(0))):
        assert none.sigma == 0 and none.u.count() == none.v.count() == 0


def test_power_iteration_says_when_it_does_not_converge(spark):
    with pytest.raises(RuntimeError):
        fc.leading_singular_value(from_dense(spark, np.diag([1.0, 0.999, 0.5])), max_iter=2)


def test_power_iteration_is_one_pass_over_the_columns(spark, monkeypatch):
    """The entries are shuffled once, whatever the steps; they agree with the plain iteration."""
    passes, stagings = [], []
    one, keep = fc._power_pass, fc.staged
    monkeypatch.setattr(fc, "_power_pass", lambda *a: passes.append(1) or one(*a))
    monkeypatch.setattr(fc, "staged", lambda *a: stagings.append(1) or keep(*a))
    monkeypatch.setattr(fc, "POWER_ROWS_PER_TASK", 20)
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(15, 40)) * 3) * (rng.random((15, 40)) > 0.5)
    x[:, 7] = 0                                          # a column without entries counts in the start
    x[3] = 0
    v, steps = np.full(40, 1 / np.sqrt(40)), 0
    while True:
        w = x.T @ (x @ v)
        steps, norm = steps + 1, np.linalg.norm(w)
        done = abs(v @ w) / norm > 1 - 1e-9
        v = w / norm
        if done:
            break
    m = from_dense(spark, x)
    extra = spark.createDataFrame([(0, 0, 1.5), (0, 0, -1.5), (2, 2, None)], m.schema)     # cancel; null
    got = fc.leading_singular_value(m.unionByName(extra), epsilon=1e-9).first()
    assert got.converged and got.iterations == steps == len(passes) and len(stagings) == 1
    assert np.isclose(got.sigma, np.sqrt(norm), rtol=1e-9)
    for none in (m.limit(0), m.limit(1).selectExpr("i", "j", "0D as value")):
        assert tuple(fc.leading_singular_value(none).first()) == (1, 0.0, False)
