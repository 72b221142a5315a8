"""Skewed logs: one item holds a third of all rows, one user is active everywhere
and one (item, user) pair repeats hundreds of times.  The pipeline must give
exactly the brute-force (DuckDB) result with no row dropped or capped, and the
salted user x user join must agree with the plain one for any block size."""

import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import to_dense
from coact.operators import matrix as mx
from coact.operators import predict as pr
from coact.operators.activity import ActivityModel, Band
from coact.operators.similarity import cosine_similarity
from coact.operators.skew import join_many
from coact.plans import cf
from coact.plans import oracle as o
from coact.sources.log import LOG_SCHEMA


def _skewed_log(n_rows: int = 6000, seed: int = 5):
    rng = random.Random(seed)
    rows = []
    hot_item_rows = n_rows // 3
    for _ in range(hot_item_rows):                                  # a third of the log on one item
        rows.append((f"u{rng.randint(0, 399):03d}", rng.choice([-3, -1, 1, 2, 5]), "hot"))
    for _ in range(n_rows - hot_item_rows - 600):
        rows.append((f"u{rng.randint(0, 399):03d}", rng.choice([-2, 1, 1, 3, 4]), f"s{rng.randint(0, 29)}"))
    for it in range(30):                                            # a bot active in every item
        rows += [("bot", 1, f"s{it}")] * 10
    rows += [("u007", 2, "s3")] * 300                                # one pair repeated many times
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def skew(spark):
    rows = _skewed_log()
    log = spark.createDataFrame(rows, LOG_SCHEMA).repartition(6)
    con = duckdb.connect()
    con.register("log_df", pd.DataFrame(rows, columns=["author", "score", "subreddit"]))
    return log, con


def _duck(con, band: Band, body: str, *extra: str) -> list:
    ctes = ["log AS (SELECT * FROM log_df)", o.PAIRS, o.band_ctes(band.top_n, band.min_items, band.max_items),
            *extra]
    return con.execute(o.with_ctes(*ctes) + body).fetchall()


def _norm(rows):
    return sorted((tuple(r) for r in rows), key=repr)


BAND = Band(top_n=20, min_items=2, max_items=12)


def test_skewed_band_tables(spark, skew):
    log, con = skew
    md = ActivityModel(log, BAND)
    assert _norm(md.users.select("user", "n_items").collect()) == _norm(
        _duck(con, BAND, 'SELECT "user", n_items FROM usr'))
    got = md.pruned.select("item", "user", "item_id", "net_score", "abs_score", "uid").collect()
    want = _duck(con, BAND, 'SELECT item, "user", item_id, net_score, abs_score, uid FROM pruned')
    assert len(want) > 1000 and len(got) == len(want) and _norm(got) == _norm(want)
    assert not any(r.user == "bot" for r in got)                    # above the band's upper bound
    # the hot item is in the top items and keeps every one of its valid users
    assert md.top.where(F.col("item") == "hot").count() == 1


def test_skewed_top_k_related(spark, skew):
    log, con = skew
    md = ActivityModel(log, BAND)
    got = cf.top_k_related(md, 4).collect()
    want = _duck(con, BAND, ", " + o.COSINE + "\n" + o.top_k_sql(4))
    assert _norm(got) == _norm(want)


@pytest.mark.parametrize("block", [3, 17, 10_000])
def test_skewed_user_cosine_any_block(spark, skew, block):
    """The hot item's audience is split into ceil(n / block) salted blocks per side."""
    log, con = skew
    md = ActivityModel(log, BAND)
    got = cosine_similarity(md.matrix, axis="cols", block=block, key_bound=BAND.top_n) \
        .select("i", "j", F.round("value", 9).alias("value")).collect()
    want = _duck(con, BAND, "SELECT i, j, round(value, 9) AS value FROM c_sim",
                 "mt AS (SELECT j AS i, i AS j, value FROM m)", *o.cosine_ctes("mt", prefix="c_"))
    assert len(want) > 100_000 and len(got) == len(want) and _norm(got) == _norm(want)


def _heavy_matrix(spark, seed: int = 3):
    """200 x 40 entries; one column holds a third of them."""
    rng = random.Random(seed)
    cells = {(i, 0) for i in range(200)} | {(rng.randint(0, 199), rng.randint(1, 39)) for _ in range(430)}
    return spark.createDataFrame([(i, j, float(rng.randint(-4, 5))) for i, j in sorted(cells)], mx.MATRIX_SCHEMA)


def test_join_many_deals_heavy_keys(spark):
    m = _heavy_matrix(spark)
    l = m.select("i", F.col("j").alias("k"))
    r = m.select(F.col("i").alias("x"), F.col("j").alias("k"), "value")
    want = l.join(r, "k").select("k", "i", "x", "value")
    got = join_many(l, r, "k", share=10, floor=7).select("k", "i", "x", "value")
    assert want.count() == got.count() > 40_000 and want.exceptAll(got).count() == 0
    none = join_many(l.where("k > 99"), r, "k")
    assert none.count() == 0 and join_many(l, r.limit(0), "k").count() == 0


def test_heavy_product_equals_brute(spark):
    m = _heavy_matrix(spark)
    dense = to_dense(m, (200, 40))
    got = to_dense(mx.multiply(m, mx.transpose(m), share=10, floor=5), (200, 200))
    assert np.array_equal(got, dense @ dense.T)


def test_product_at_cells(spark):
    m = _heavy_matrix(spark)
    dense = to_dense(m, (200, 40))
    full = dense.T @ dense
    cells = [(0, 0), (0, 5), (3, 0), (39, 39), (7, 7), (0, 0), (99, 1)]
    want = spark.createDataFrame(cells, "i long, j long")
    got = {(r.i, r.j): r.value for r in mx.multiply_at(mx.transpose(m), m, want, share=10, floor=5).collect()}
    assert got == {c: full[c] for c in cells if c != (99, 1) and (dense[:, c[0]] * dense[:, c[1]] != 0).any()} | {
        c: 0.0 for c in got if full[c] == 0}


@pytest.mark.parametrize("kind", ["user", "item"])
def test_sampled_prediction_equals_the_dense_one(spark, skew, kind):
    log, _ = skew
    r = mx.transpose(ActivityModel(log, BAND).matrix).cache()
    train, test = (x.cache() for x in pr.train_test_split(r))
    s = pr.similarity_for(train, kind).cache()
    dense = {(x.i, x.j): x.value for x in pr.predict_bias_corrected(train, s, kind).collect()}
    got = pr.predict_at(train, s, test, kind).collect()
    asked = {(x.i, x.j): x.value for x in test.collect()}
    assert {(x.i, x.j) for x in got} == asked.keys() & dense.keys() and len(got) > 500
    assert all(abs(x.value - dense[x.i, x.j]) <= 1e-9 * (1 + abs(x.value)) for x in got)
    assert np.isclose(pr.mse(spark.createDataFrame(got), test).first().mse,
                      np.mean([(dense[c] - v) ** 2 for c, v in asked.items() if c in dense]))
    for x in (r, train, test, s):
        x.unpersist()
