"""Look-ups over the served LSA profile, against numpy and plain Python."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest

from coact.operators import factor as fc
from coact.plans import catalog as cat
from coact.plans import lsa

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def profile(spark):
    """item -> related names, from numpy's SVD of the weighted matrix."""
    md = cat.lsa_model(spark, SF)
    names = {r.i: r.item for r in md.item_names.collect()}
    cells = lsa.weighted_matrix(md).select("i", "j", "value").collect()
    users = {j: n for n, j in enumerate(sorted({r.j for r in cells}))}
    rows = {i: n for n, i in enumerate(sorted({r.i for r in cells}))}
    x = np.zeros((len(rows), len(users)))
    for r in cells:
        x[rows[r.i], users[r.j]] += r.value
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    kept = s > 1e-9 * s[0]
    latent = u[:, kept] * s[kept] ** fc.LATENT_POWER
    latent /= np.linalg.norm(latent, axis=1)[:, None]
    sims = latent @ latent.T
    return {names[i]: sorted(((float(sims[n, m]), names[j]) for j, m in rows.items() if i != j), reverse=True)
            for i, n in rows.items()}, names


@pytest.fixture(scope="module")
def served(spark):
    prof, hist = cat._lsa_served(spark, SF)
    return ({r.item: list(r.related) for r in prof.read(spark).collect()},
            {r.user: list(r["items"]) for r in hist.read(spark).collect()})


def test_profile_has_the_closest_items(profile, served):
    want, names = profile
    assert set(served[0]) == set(names.values())
    for item, related in served[0].items():
        sim = {n: v for v, n in want.get(item, [])}
        best = [v for v, _ in want.get(item, [])][:lsa.LSA_K - 1]
        assert len(related) == len(set(related)) == len(best)
        assert np.allclose([sim[n] for n in related], best, atol=1e-6)       # equal up to ties


def test_bag_and_recommendations(spark, served):
    prof, hist = served
    bag = {u: [(v, vpos, rpos, c) for vpos, v in enumerate(items) for rpos, c in enumerate(prof.get(v, []))]
           for u, items in hist.items()}
    assert any(bag.values())
    counts = {u: Counter(c for *_, c in b) for u, b in bag.items()}
    got = {(r.user, r.candidate): r.copies for r in cat.q_lsa_candidate_bag(spark, SF).collect()}
    assert got == {(u, c): n for u, own in counts.items() for c, n in own.items()}
    ranked = {(r.user, r.rk): r.candidate for r in cat.q_lsa_recommend_ranked(spark, SF).collect()}
    assert ranked == {(u, k): c for u, own in counts.items()
                      for k, (c, _) in enumerate(sorted(own.items(), key=lambda e: (-e[1], e[0]))[:20], 1)}
    sampled = {(r.user, r.pick): r.candidate for r in cat.q_lsa_recommend_sampled(spark, SF).collect()}
    drawn = {u: sorted(b, key=lambda e: (hashlib.md5(f"42|{u}|{e[0]}|{e[2]}".encode()).hexdigest(), e[1], e[2]))[:20]
             for u, b in bag.items()}
    assert sampled == {(u, k): e[3] for u, own in drawn.items() for k, e in enumerate(own, 1)}


def test_roundtrip_and_answers(spark, served):
    prof, hist = served
    rows = cat.q_lsa_serving_roundtrip(spark, SF).collect()
    assert sorted((r.user, r.item, r.n_related) for r in rows) == sorted(
        (u, i, len(prof[i])) for u, items in hist.items() for i in items)
    assert {r.dims for r in rows} == {cat.lsa_factors(spark, SF).k}
    answers = {r.request: r.answer for r in cat.q_lsa_related_answer_text(spark, SF).collect()}
    assert answers[""] == "" and "no such" in answers["no-such-item"]
    known = [k for k in answers if k in prof]
    assert len(known) == 2 and all(answers[k].split("\n")[1:] == prof[k] for k in known)


def test_pivot_neighbours_are_the_first_of_the_full_ranking(spark):
    full = {(r.uid, r.rk): r.sim for r in cat.q_latent_neighbors(spark, SF).where(f"rk <= {lsa.LSA_K}").collect()}
    got = {(r.uid, r.rk): r.sim for r in cat.q_latent_neighbors_topk(spark, SF).collect()}
    assert got.keys() == full.keys() and all(abs(got[k] - full[k]) < 1e-8 for k in full)
