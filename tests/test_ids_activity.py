"""Dense ids and the activity tables on edge-case logs, against DuckDB running
the reference's own SQL shape (global dense_rank windows, IN sub-selects)."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from coact.operators.activity import ActivityModel, Band, most_active_items
from coact.operators.ids import dense_ids
from coact.plans import cf
from coact.plans import oracle as o
from coact.sources.log import LOG_SCHEMA


def test_dense_ids_match_dense_rank(spark):
    import random
    random.seed(11)
    keys = [f"k{random.randint(0, 300)}" for _ in range(2000)] + [None, None]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for desc in (True, False):
        got = {r.k: r.id for r in dense_ids(df, "k", "id", descending=desc, num_partitions=7).collect()}
        distinct = sorted({k for k in keys if k is not None}, reverse=desc)
        # Spark / SQL: DESC puts NULL last, ASC puts NULL first
        order = distinct + [None] if desc else [None] + distinct
        assert got == {k: n + 1 for n, k in enumerate(order)}


def test_dense_ids_single_partition_and_empty(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "k string")
    assert {r.k: r.id for r in dense_ids(df, "k", "id", num_partitions=1).collect()} == {"a": 1, "b": 2}
    empty = spark.createDataFrame([], "k string")
    assert dense_ids(empty, "k", "id").count() == 0


# Edge cases: NULL author, NULL score, score 0, votes that cancel, equal-activity
# items, a user in one item only, many users so the band matters.
def _edge_log():
    rows = []
    for u in range(12):
        for it in range(5):
            if (u + it) % 4 != 0:
                rows.append((f"u{u:02d}", (u % 3) - 1 or 2, f"s{it}"))
    rows += [("u00", 5, "s0"), ("u00", -5, "s0"), ("u00", -5, "s0")]      # cancel then negative
    rows += [("u01", 3, "s1"), ("u01", -3, "s1")]                        # votes cancel: tally 0
    rows += [(None, 4, "s2"), (None, 4, "s3")]                            # NULL author
    rows += [("u02", None, "s4"), ("u03", 0, "s4")]                       # NULL score, score 0
    rows += [("lonely", 7, "s9")]                                         # one user, one item
    rows += [("u04", 2, "tie_a"), ("u05", 2, "tie_b")]                    # equal-activity items
    return rows


@pytest.fixture(scope="module")
def edge(spark):
    rows = _edge_log()
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    con = duckdb.connect()
    con.register("log_df", pd.DataFrame(rows, columns=["author", "score", "subreddit"]).astype(
        {"score": "Int64"}))
    return log, con


def _duck(con, sql_body: str, band: Band | None = None) -> list:
    ctes = ["log AS (SELECT * FROM log_df)", o.PAIRS]
    if band:
        ctes.append(o.band_ctes(band.top_n, band.min_items, band.max_items))
    else:
        ctes.append(o.OCC)
    return con.execute(o.with_ctes(*ctes) + sql_body).fetchall()


def _norm(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_item_user_activity_edge(spark, edge):
    log, con = edge
    md = ActivityModel(log, Band(3, 1, 3))
    got = md.occurrences.select("item", "user", "net_votes", "comments", "uid", "rid").collect()
    want = _duck(con, 'SELECT item, "user", net_votes, comments, uid, '
                      'dense_rank() OVER (ORDER BY item DESC) AS rid FROM occ')
    assert _norm(got) == _norm(want)


def test_most_active_items_keeps_ties(spark, edge):
    log, con = edge
    md = ActivityModel(log, Band(6, 1, 3))
    got = most_active_items(md.occurrences, 6).select("item", "activity", "ordered_id").collect()
    want = _duck(con, """SELECT item, activity, ordered_id FROM (
        SELECT item, activity, dense_rank() OVER (ORDER BY activity DESC) AS ordered_id
        FROM (SELECT item, sum(comments) AS activity FROM occ GROUP BY item)) WHERE ordered_id <= 6""")
    assert _norm(got) == _norm(want)


@pytest.mark.parametrize("band", [Band(3, 1, 3), Band(4, 2, 2), Band(10, 1, 10)])
def test_band_tables_edge(spark, edge, band):
    log, con = edge
    md = ActivityModel(log, band)
    assert _norm(md.users.select("user", "n_items").collect()) == _norm(
        _duck(con, 'SELECT "user", n_items FROM usr', band))
    assert _norm(md.pruned.select("item", "user", "item_id", "net_score", "abs_score", "uid").collect()) == _norm(
        _duck(con, 'SELECT item, "user", item_id, net_score, abs_score, uid FROM pruned', band))
    got = cf.top_k_related(md, 3).collect()
    want = _duck(con, ", " + o.COSINE + "\n" + o.top_k_sql(3), band)
    assert _norm(got) == _norm(want)


def test_unknown_user_and_item_give_nothing(spark, edge):
    from coact.operators.serving import items_of_user
    from coact.operators.similarity import related_to_item
    log, _ = edge
    md = ActivityModel(log, Band(3, 1, 3))
    assert items_of_user(md.occ_nonzero, "nobody").count() == 0
    req = spark.createDataFrame([("nothing-here",)], "item string")
    assert related_to_item(cf.top_k_related(md, 3), req).count() == 0


def test_null_author_is_its_own_group(spark, edge):
    log, _ = edge
    md = ActivityModel(log, Band(3, 1, 3))
    nulls = md.occurrences.where(F.col("user").isNull()).collect()
    assert len(nulls) == 2 and len({r.uid for r in nulls}) == 1
    assert nulls[0].uid == md.occurrences.agg(F.max("uid")).first()[0]


def test_ranges_follow_the_number_of_keys(spark, monkeypatch):
    from coact.operators import ids
    keys = spark.range(5000).select(F.concat(F.lit("k"), F.col("id") % 1000).alias("k")).unionByName(
        spark.range(1).select(F.lit(None).cast("string").alias("k")))
    assert ids.range_count(keys, "k") == 1 and ids.range_count(keys.limit(0), "k") == 1
    monkeypatch.setattr(ids, "KEYS_PER_RANGE", 100)
    assert 9 <= ids.range_count(keys, "k") <= 11
    got = [(r.k, r.n) for r in ids.dense_ids(keys, "k", "n").orderBy("n").collect()]
    want = [None, *sorted({f"k{i}" for i in range(1000)})]
    assert got == [(k, n) for n, k in enumerate(want, 1)]


def test_item_ranks_do_not_rerun_the_user_join(spark, monkeypatch):
    from coact.operators import activity, ids
    ranked = []
    real = ids.dense_ids

    def spy(keys, *a, **kw):
        ranked.append(keys._jdf.queryExecution().optimizedPlan().toString())
        return real(keys, *a, **kw)

    monkeypatch.setattr(ids, "dense_ids", spy)
    pairs = spark.createDataFrame([("a", "u1", 1, 2), ("b", "u1", 0, 1), ("a", "u2", -1, 1), ("c", "u3", 2, 2)],
                                  "item string, user string, net_votes long, comments long")
    out = {(r.item, r.user): (r.uid, r.rid) for r in activity.item_user_activity(pairs).collect()}
    assert out == {("a", "u1"): (3, 2), ("a", "u2"): (2, 2), ("c", "u3"): (1, 1)}
    assert len(ranked) == 2 and not any("Join" in p for p in ranked)


def test_rows_of_a_task_follow_the_data(spark, edge, monkeypatch):
    from coact.operators import activity
    from coact.sources import log as src
    log, con = edge
    pairs = activity.pair_activity(log, 7)
    sizes = pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) > 1 and {r.p for r in sizes} <= set(range(7))            # not coalesced by bytes
    assert pairs.rdd.getNumPartitions() == 7
    for band in (Band(3, 1, 3), Band(4, 2, 2)):
        md = ActivityModel(log, band, tasks=5)
        assert _norm(md.pruned.select("item", "user", "item_id", "net_score", "abs_score", "uid").collect()) == _norm(
            _duck(con, 'SELECT item, "user", item_id, net_score, abs_score, uid FROM pruned', band))
    rows = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert src.log_tasks(spark, "/root/testdata/sf0.001") is None
    before = activity.pair_activity(src.load_log(spark, "/root/testdata/sf0.001"))
    monkeypatch.setattr(src, "ROWS_PER_TASK", rows // 10)
    assert src.log_tasks(spark, "/root/testdata/sf0.001") in (10, 11)
    after = activity.pair_activity(src.load_log(spark, "/root/testdata/sf0.001"), 11)
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()


def test_only_pairs_of_top_items_meet_the_users(spark, edge):
    from coact.operators import activity
    log, _ = edge
    md = ActivityModel(log, Band(3, 1, 3))
    plan = activity.kept_pairs(md.pairs, md.top, md.users, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and not any("LeftSemi" in line and "user" in line for line in plan.splitlines())


def test_top_items_and_users_are_computed_once(spark, edge, tmp_path):
    log, _ = edge
    md = ActivityModel(log, Band(3, 1, 3), stage_dir=str(tmp_path / "activity"))
    plain = ActivityModel(log, Band(3, 1, 3))
    for staged, lazy in ((md.top, plain.top), (md.users, plain.users)):
        assert "Aggregate" not in staged._jdf.queryExecution().optimizedPlan().toString()
        assert _norm(staged.collect()) == _norm(lazy.collect())
