"""Serving tables, lookups and text answers."""

import numpy as np
from pyspark.sql import functions as F

from coact.functions import text as tx
from coact.operators import serving as sv


def _profile(spark):
    related = spark.createDataFrame(
        [("a", "b", 1), ("a", "c", 2), ("b", "a", 1), ("b", "c", 2), ("c", "a", 1), ("c", "b", 2)],
        "item string, related string, rk long")
    act = spark.createDataFrame([("a", 10), ("b", 5), ("c", 1), ("d", 3)], "item string, activity long")
    vec = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0]), ("c", [3.0, 4.0]), ("d", [1.0, 1.0])],
                                "item string, vector array<double>")
    return sv.item_profile(related, act, vec)


def test_item_profile_keeps_rank_order_and_empty_lists(spark):
    p = {r.item: list(r.related) for r in _profile(spark).collect()}
    assert p == {"a": ["b", "c"], "b": ["a", "c"], "c": ["a", "b"], "d": []}


def test_profile_roundtrip_parquet(spark, tmp_path):
    path = str(tmp_path / "profile")
    sv.write_table(_profile(spark), path)
    back = sv.read_table(spark, path)
    assert back.count() == 4 and dict(back.dtypes)["related"] == "array<string>"


def test_history_bag_and_recommendations(spark):
    pruned = spark.createDataFrame([("a", "u1"), ("b", "u1"), ("c", "u2"), ("zz", "u2")], "item string, user string")
    hist = sv.user_history(pruned)
    assert {r.user: list(r.items) for r in hist.collect()} == {"u1": ["a", "b"], "u2": ["c", "zz"]}
    bag = sv.candidate_bag(hist, _profile(spark))
    mult = {(r.user, r.candidate): r.copies for r in sv.bag_multiplicity(bag).collect()}
    assert mult == {("u1", "b"): 1, ("u1", "c"): 2, ("u1", "a"): 1, ("u2", "a"): 1, ("u2", "b"): 1}
    sampled = sv.recommend_sampled(bag, n=3).collect()
    assert sum(1 for r in sampled if r.user == "u1") == 3        # 4 entries in the bag, 3 drawn
    assert sum(1 for r in sampled if r.user == "u2") == 2        # fewer than n: what there is
    ranked = sv.recommend_ranked(bag, n=2).where(F.col("user") == "u1").orderBy("rk").collect()
    assert [r.candidate for r in ranked] == ["c", "a"]
    excl = sv.recommend_ranked(bag, n=5, exclude_visited=hist).where(F.col("user") == "u1").collect()
    assert {r.candidate for r in excl} == {"c"}


def test_answers(spark):
    req = spark.createDataFrame([("a",), ("nope",), ("",), ("d",)], "item string")
    got = {r.request: r.answer for r in sv.related_answers(req, _profile(spark)).collect()}
    assert got["a"] == "subs related to r/a:\nb\nc"
    assert got["nope"] == "nope: no such subreddit"
    assert got[""] == ""
    assert got["d"] == "subs related to r/d:\n"
    link = spark.range(1).select(tx.item_link(F.lit("x")).alias("l")).first().l
    assert link == '<a href="http://reddit.com/r/x"> r/x </a> <br/>'


def test_projection(spark):
    excl = spark.createDataFrame([("a",)], "item string")
    pts = {r.item: r for r in sv.projection_2d(_profile(spark), exclude=excl).collect()}
    assert "a" not in pts
    assert min(p.x for p in pts.values()) == 0.0 and min(p.y for p in pts.values()) == 0.0
    assert np.isclose(pts["b"].size, 0.05 * np.sqrt(5))
    assert np.isclose(pts["c"].x - pts["b"].x, 3 / 5)


def test_activity_all_users_fanout_count(spark):
    occ = spark.createDataFrame([("u1", "a", 3), ("u2", "a", 1), ("u3", "b", 2)], "user string, item string, comments long")
    pruned = spark.createDataFrame([("a", 1, "u1"), ("a", 1, "u9"), ("b", 2, "u3")], "item string, item_id long, user string")
    got = {(r.user, r.item): r.copies for r in sv.activity_all_users(occ, pruned).collect()}
    # the many-to-many join would repeat every row of item a twice
    assert got == {("u1", "a"): 2, ("u2", "a"): 2, ("u3", "b"): 1}
