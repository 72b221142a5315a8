"""``score_topk`` against a brute-force ranking, both modes, with a full ranking."""

import numpy as np
import pytest

from coact.operators import factor as fc


@pytest.mark.parametrize("mode", ["dot", "cosine"])
@pytest.mark.parametrize("k", [3, 7])
def test_score_topk_is_the_brute_force_ranking(spark, mode, k):
    rng = np.random.default_rng(5)
    f = fc.Factors(np.arange(10, 17), np.linalg.qr(rng.normal(size=(7, 3)))[0], np.array([5.0, 2.0, 1.0]))
    queries = rng.normal(size=(6, 3))
    df = spark.createDataFrame([(r, q.tolist()) for r, q in enumerate(queries)], "row long, vector array<double>")
    items = f.u * f.s ** 0.5 if mode == "cosine" else f.u * f.s ** -0.5
    want = queries @ items.T
    if mode == "cosine":
        want = want / np.linalg.norm(queries, axis=1)[:, None] / np.linalg.norm(items, axis=1)[None, :]
    got = fc.score_topk(spark, df, f, k, -0.5, mode=mode).collect()
    assert len(got) == 6 * k
    for r in got:
        order = sorted(range(7), key=lambda c: (-want[r.row, c], c))
        assert r.i == f.index[order[r.rk - 1]]
        assert r.score == pytest.approx(want[r.row, order[r.rk - 1]], abs=1e-8)
