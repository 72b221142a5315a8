"""``score_topk``: the rows that a task makes at once are bounded, whatever ``k`` is."""

import numpy as np

from coact.operators import factor as fc


def test_results_of_a_chunk_are_bounded():
    assert fc._chunk_rows(6000, 6000) * 6000 <= 1 << 20          # 2,796 rows of 6,000 results before: 537 MB
    assert fc._chunk_rows(50_000, 250) * 50_000 <= 1 << 22
    assert fc._chunk_rows(10 ** 9, 10 ** 9) == 1


def test_full_ranking_with_ties_and_a_zero_request(spark, monkeypatch):
    """In chunks of two requests; equal scores go by item, a request without a direction has no result."""
    chunk, sizes = fc._chunk_rows, []
    monkeypatch.setattr(fc, "_chunk_rows", lambda *a: sizes.append(a) or min(2, chunk(*a)))
    u = np.repeat(np.eye(3), 3, axis=0) / np.sqrt(3)
    f = fc.Factors(np.arange(5, 14) * 2, u, np.ones(3))
    asked = [(0, [1.0, 0.0, 0.0]), (1, [0.0, 2.0, 1.0]), (2, [0.0, 0.0, 0.0]), (3, [1.0, 1.0, 1.0]), (4, [-1.0, 0.0, 0.5])]
    df = spark.createDataFrame(asked, "row long, vector array<double>").coalesce(1)
    got = {}
    for r in fc.score_topk(spark, df, f, 9, 0.0, mode="cosine").collect():
        got.setdefault(r.row, []).append((r.rk, r.i, r.score))
    assert set(got) == {0, 1, 3, 4}
    for row, q in asked:
        if row in got:
            sim = np.round(u @ q / np.linalg.norm(q) / np.linalg.norm(u, axis=1), 9)
            best = sorted(range(9), key=lambda c: (-sim[c], c))
            assert sorted(got[row]) == [(n, int(f.index[c]), sim[c]) for n, c in enumerate(best, 1)]
