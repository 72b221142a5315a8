"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query starts from a log adapter over the driver tables (see
:mod:`coact.sources.log`) so its work grows with the data.  The activity
tables of one (adapter, band) are shared between the queries of a process via
:func:`model`.  The matching DuckDB SQL lives in :mod:`coact.plans.oracle`.
"""

from __future__ import annotations

from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coact.functions import text as tx
from coact.operators import factor as fc
from coact.operators import matrix as mx
from coact.operators import pivots as pv
from coact.operators import predict as pr
from coact.operators import serving as sv
from coact.operators import store
from coact.operators import weighting as wt
from coact.operators.activity import ActivityModel, Band, item_activity, most_active_items
from coact.operators.bidiagonal import leading_triple
from coact.operators.nearest import top_k_neighbours
from coact.operators.similarity import cosine_rows, cosine_similarity, top_k_per_row
from coact.plans import cf, lsa
from coact.plans.cf import CF_BAND
from coact.session import scratch_dir
from coact.sources import files as fs
from coact.sources.log import load_log, log_from_events, log_tasks, read_table

# The registered queries use the CF and LSA bands of the two batches;
# their DuckDB SQL is built from the same values.
CF_Q = CF_BAND
CF_K = 10

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}

_MODELS: dict[tuple, ActivityModel] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def model(spark: SparkSession, sf_dir: str, adapter: str = "orders", band: Band = CF_Q) -> ActivityModel:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), adapter, band)
    if key not in _MODELS:
        _MODELS[key] = ActivityModel(load_log(spark, sf_dir, adapter), band,
                                     stage_dir=scratch_dir(spark, "activity"),
                                     tasks=log_tasks(spark, sf_dir, adapter)).materialize()
    return _MODELS[key]


def reset_models() -> None:
    for m in _MODELS.values():
        m.unpersist()
    _MODELS.clear()
    _SERVED.clear()


# --- activity tables -----------------------------------------------------------

@query("item_user_activity")
def q_item_user_activity(spark, sf_dir):
    return model(spark, sf_dir).occurrences.select("item", "user", "net_votes", "comments", "uid", "rid")


@query("most_active_items")
def q_most_active_items(spark, sf_dir):
    return most_active_items(model(spark, sf_dir).occurrences, CF_Q.top_n)


@query("valid_users")
def q_valid_users(spark, sf_dir):
    return model(spark, sf_dir).users.select("user", "n_items")


@query("top_users")
def q_top_users(spark, sf_dir):
    return model(spark, sf_dir).users.orderBy(F.desc("n_items"), F.asc("user")).select("user", "n_items")


@query("pruned_activity")
def q_pruned_activity(spark, sf_dir):
    return model(spark, sf_dir).pruned.select("item", "user", "item_id", "net_score", "abs_score", "uid")


@query("log_of_top_items")
def q_log_of_top_items(spark, sf_dir):
    m = model(spark, sf_dir)
    return m.log.join(F.broadcast(m.top.select(F.col("item").alias("subreddit"), "item_id")), "subreddit") \
        .select("author", "score", "subreddit", "item_id")


@query("matrix_triples")
def q_matrix_triples(spark, sf_dir):
    return model(spark, sf_dir).pruned.select("item_id", "uid", "net_score")


@query("frequency_matrix")
def q_frequency_matrix(spark, sf_dir):
    return model(spark, sf_dir).matrix


# --- similarity ------------------------------------------------------------------

@query("top_k_related")
def q_top_k_related(spark, sf_dir):
    return cf.top_k_related(model(spark, sf_dir), CF_K)


# Band for the events adapter (its users touch 34-64 of 100 items).
EVENTS_Q = Band(top_n=100, min_items=20, max_items=60)


@query("top_k_related_events")
def q_top_k_related_events(spark, sf_dir):
    """The flagship over the events log (item = a JSON field of each event)."""
    return cf.top_k_related(model(spark, sf_dir, adapter="events", band=EVENTS_Q), CF_K)


# --- COO matrix layer (on the CF frequency matrix) ---------------------------------



EPS = 1e-9
SMOOTHING = 1.0              # large enough to order items without a common user by their norms


def r6(df: DataFrame, col: str = "value") -> DataFrame:
    return df.withColumn(col, F.round(col, 6))


def r9(df: DataFrame, col: str = "value") -> DataFrame:
    return df.withColumn(col, F.round(col, 9))


def tf(spark, sf_dir) -> DataFrame:
    return model(spark, sf_dir).matrix


def row_vector(m: DataFrame, k: int) -> DataFrame:
    """Row ``k`` of a matrix as a vector over its column index."""
    return mx.row(m, k).select(F.col("j").alias("i"), "value")


@query("matrix_transpose")
def q_matrix_transpose(spark, sf_dir):
    return mx.transpose(tf(spark, sf_dir))


@query("matrix_identity")
def q_matrix_identity(spark, sf_dir):
    return mx.identity(tf(spark, sf_dir))


@query("matrix_densify")
def q_matrix_densify(spark, sf_dir):
    return mx.densify(tf(spark, sf_dir))


@query("vector_densify")
def q_vector_densify(spark, sf_dir):
    return mx.vector_densify(row_vector(tf(spark, sf_dir), 0))


@query("matrix_from_dense")
def q_matrix_from_dense(spark, sf_dir):
    return r9(mx.from_dense_rows(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))


@query("matrix_nnz")
def q_matrix_nnz(spark, sf_dir):
    return mx.nnz(tf(spark, sf_dir))


@query("take_first_n")
def q_take_first_n(spark, sf_dir):
    return mx.take_first(tf(spark, sf_dir), 10)


@query("matrix_diagonal")
def q_matrix_diagonal(spark, sf_dir):
    m = tf(spark, sf_dir)
    return mx.diagonal(mx.multiply(m, mx.transpose(m)))


@query("matrix_row")
def q_matrix_row(spark, sf_dir):
    return mx.row(tf(spark, sf_dir), 0)


@query("matrix_nan_count")
def q_matrix_nan_count(spark, sf_dir):
    return mx.nan_count(wt.log_entropy(tf(spark, sf_dir), row_bound=CF_Q.top_n))


@query("matrix_drop_first")
def q_matrix_drop_first(spark, sf_dir):
    return mx.drop_first(mx.transpose(tf(spark, sf_dir)))


@query("matrix_add")
def q_matrix_add(spark, sf_dir):
    m = tf(spark, sf_dir)
    return mx.add(m, mx.transpose(m), -2.0)


@query("matrix_hadamard")
def q_matrix_hadamard(spark, sf_dir):
    m = tf(spark, sf_dir)
    return r6(mx.hadamard(m, wt.log_frequency(m)))


@query("matrix_row_divide")
def q_matrix_row_divide(spark, sf_dir):
    m = tf(spark, sf_dir)
    return r9(mx.row_divide(m, F.broadcast(mx.row_norms(m))))


@query("matrix_row_scale")
def q_matrix_row_scale(spark, sf_dir):
    m = tf(spark, sf_dir)
    counts = m.groupBy("i").agg(F.count(F.lit(1)).cast("double").alias("value"))
    return mx.row_scale(m, F.broadcast(counts))


@query("matrix_multiply")
def q_matrix_multiply(spark, sf_dir):
    m = tf(spark, sf_dir)
    return mx.multiply(m, mx.transpose(m))


@query("matrix_multiply_threshold")
def q_matrix_multiply_threshold(spark, sf_dir):
    m = tf(spark, sf_dir)
    return mx.multiply(m, mx.transpose(m), zero_threshold=1000.0)


@query("matrix_add_constant")
def q_matrix_add_constant(spark, sf_dir):
    return mx.add_constant(tf(spark, sf_dir), 0.5)


@query("matrix_scalar_multiply")
def q_matrix_scalar_multiply(spark, sf_dir):
    return mx.scalar_multiply(tf(spark, sf_dir), -2.0)


@query("matrix_map_values")
def q_matrix_map_values(spark, sf_dir):
    return r9(mx.map_values(tf(spark, sf_dir), lambda v: F.sqrt(F.abs(v))))


def _sqrt_abs(s: pd.Series) -> pd.Series:
    return pd.Series(np.sqrt(np.abs(s.to_numpy(dtype="float64"))))


@query("matrix_map_values_udf")
def q_matrix_map_values_udf(spark, sf_dir):
    return r9(mx.map_values_udf(tf(spark, sf_dir), _sqrt_abs))


@query("vector_map_values")
def q_vector_map_values(spark, sf_dir):
    m = tf(spark, sf_dir)
    sq = m.groupBy("i").agg(F.sum(F.col("value") * F.col("value")).alias("value"))
    return r9(mx.vector_map_values(sq, F.sqrt))


@query("matrix_row_sum")
def q_matrix_row_sum(spark, sf_dir):
    return mx.row_sum(tf(spark, sf_dir))


@query("matrix_rows_packed")
def q_matrix_rows_packed(spark, sf_dir):
    packed = mx.rows_packed(mx.transpose(tf(spark, sf_dir)))
    return packed.select("i", F.size("indices").cast("bigint").alias("size"),
                         F.array_join(F.transform("indices", lambda x: x.cast("string")), ",").alias("indices"),
                         F.aggregate("values", F.lit(0.0), lambda a, x: a + x).alias("val_sum"))


@query("matrix_shape")
def q_matrix_shape(spark, sf_dir):
    return mx.shape(tf(spark, sf_dir))


@query("vector_norm")
def q_vector_norm(spark, sf_dir):
    return r9(mx.vector_norm(row_vector(tf(spark, sf_dir), 0)), "norm")


@query("column_std")
def q_column_std(spark, sf_dir):
    return r9(mx.column_std(mx.transpose(tf(spark, sf_dir))))


@query("vector_unit_distance")
def q_vector_unit_distance(spark, sf_dir):
    m = tf(spark, sf_dir)
    return r9(mx.unit_distance(row_vector(m, 0), row_vector(m, 1)), "distance")


@query("rows_by_distance")
def q_rows_by_distance(spark, sf_dir):
    m = tf(spark, sf_dir)
    return r9(mx.rows_by_distance(m, row_vector(m, 0)), "distance").orderBy("distance", "i")


@query("row_coverage_diff")
def q_row_coverage_diff(spark, sf_dir):
    m = tf(spark, sf_dir)
    return m.select(F.col("j").alias("j")).distinct().subtract(
        mx.row(m, 0).select("j").distinct())


@query("distinct_users")
def q_distinct_users(spark, sf_dir):
    return model(spark, sf_dir).pairs.where(F.col("net_votes") != 0).select("user").distinct()


@query("distinct_item_ids")
def q_distinct_item_ids(spark, sf_dir):
    return q_most_active_items(spark, sf_dir).select("ordered_id").distinct()


# --- weighting -------------------------------------------------------------------

@query("global_frequency")
def q_global_frequency(spark, sf_dir):
    return wt.global_frequency(tf(spark, sf_dir))


@query("relative_frequency")
def q_relative_frequency(spark, sf_dir):
    return r9(wt.relative_frequency(tf(spark, sf_dir), row_bound=CF_Q.top_n))


@query("entropy_weight")
def q_entropy_weight(spark, sf_dir):
    return r6(wt.entropy_weight(tf(spark, sf_dir), row_bound=CF_Q.top_n))


@query("log_frequency")
def q_log_frequency(spark, sf_dir):
    return r6(wt.log_frequency(tf(spark, sf_dir)))


@query("signed_log_frequency")
def q_signed_log_frequency(spark, sf_dir):
    return r6(wt.signed_log_frequency(tf(spark, sf_dir)))


@query("log_entropy_matrix")
def q_log_entropy_matrix(spark, sf_dir):
    return r6(wt.log_entropy(tf(spark, sf_dir), row_bound=CF_Q.top_n))


# --- similarity variants ------------------------------------------------------------

@query("cosine_similarity_items")
def q_cosine_similarity_items(spark, sf_dir):
    return r9(cosine_similarity(tf(spark, sf_dir), row_bound=CF_Q.top_n))


@query("cosine_similarity_users")
def q_cosine_similarity_users(spark, sf_dir):
    return r9(cosine_similarity(tf(spark, sf_dir), axis="cols", block=pr_block(), key_bound=CF_Q.top_n))


@query("similar_users_topk")
def q_similar_users_topk(spark, sf_dir):
    return top_k_neighbours(tf(spark, sf_dir), CF_K, axis="cols")


def pr_block() -> int:
    from coact.operators.predict import USER_PAIR_BLOCK
    return USER_PAIR_BLOCK


@query("cosine_similarity_eps")
def q_cosine_similarity_eps(spark, sf_dir):
    return r9(cosine_similarity(tf(spark, sf_dir), epsilon=EPS, include_diagonal=True,
                                row_bound=CF_Q.top_n))


@query("std_normalized_matrix")
def q_std_normalized_matrix(spark, sf_dir):
    return r9(mx.scale_columns_to_unit_std(mx.transpose(tf(spark, sf_dir)), col_bound=CF_Q.top_n))


def _requests(md: ActivityModel, n: int) -> DataFrame:
    """Lookup requests derived from the data: the n most active item names + one unknown name."""
    known = md.top.where(F.col("item_id") <= n).select("item")
    unknown = md.top.limit(1).select(F.lit("no-such-item").alias("item"))
    return known.unionByName(unknown)


@query("related_to_item")
def q_related_to_item(spark, sf_dir):
    md = model(spark, sf_dir)
    topk = top_k_per_row(cf.item_similarity(md), 5, names=md.item_names, name_bound=CF_Q.top_n)
    return topk.join(F.broadcast(_requests(md, 2)), "item", "left_semi")


@query("related_with_epsilon")
def q_related_with_epsilon(spark, sf_dir):
    """Related items of the two most active ones by the smoothed cosine, items without a common user too."""
    md = model(spark, sf_dir)
    first = md.top.where(F.col("item_id") <= 2).select((F.col("item_id") - 1).cast("bigint").alias("i"))
    sims = cosine_rows(md.matrix, first, CF_Q.top_n, epsilon=SMOOTHING)
    return top_k_per_row(sims, CF_K, names=md.item_names, name_bound=CF_Q.top_n)


@query("item_dictionary")
def q_item_dictionary(spark, sf_dir):
    return model(spark, sf_dir).top.select((F.col("item_id") - 1).alias("i"), "item", "item_id")


# --- split, bias, prediction -----------------------------------------------------------


TOPK_NEIGHBOURS = 40


def ratings(spark, sf_dir) -> DataFrame:
    """Ratings matrix: users (uid) x items (item index), the transposed frequency matrix."""
    return mx.transpose(tf(spark, sf_dir))


@query("split_test")
def q_split_test(spark, sf_dir):
    return pr.train_test_split(ratings(spark, sf_dir))[1]


@query("split_train")
def q_split_train(spark, sf_dir):
    return pr.train_test_split(ratings(spark, sf_dir))[0]


@query("rating_bias")
def q_rating_bias(spark, sf_dir):
    r = ratings(spark, sf_dir)
    users = pr.row_means(r).select(F.lit("user").alias("kind"), F.col("i").alias("id"), "value")
    items = pr.col_means(r).select(F.lit("item").alias("kind"), F.col("i").alias("id"), "value")
    return r9(users.unionByName(items).withColumnRenamed("value", "mean"), "mean")


@query("predict_bias_corrected_user")
def q_predict_bias_corrected_user(spark, sf_dir):
    r = ratings(spark, sf_dir)
    return r6(pr.predict_bias_corrected(r, pr.similarity_for(r, "user", item_bound=CF_Q.top_n), "user"))


@query("predict_bias_corrected_item")
def q_predict_bias_corrected_item(spark, sf_dir):
    r = ratings(spark, sf_dir)
    s = cosine_similarity(r, axis="cols", epsilon=EPS, include_diagonal=True, row_bound=CF_Q.top_n)
    return r6(pr.predict_bias_corrected(r, s, "item"))


@query("predict_topk_user")
def q_predict_topk_user(spark, sf_dir):
    r = ratings(spark, sf_dir)
    return r6(pr.predict_topk(r, pr.similarity_for(r, "user", item_bound=CF_Q.top_n), "user", TOPK_NEIGHBOURS))


@query("predict_topk_item")
def q_predict_topk_item(spark, sf_dir):
    r = ratings(spark, sf_dir)
    s = cosine_similarity(r, axis="cols", epsilon=EPS, include_diagonal=True, row_bound=CF_Q.top_n)
    return r6(pr.predict_topk(r, s, "item", TOPK_NEIGHBOURS))


@query("prediction_mse")
def q_prediction_mse(spark, sf_dir):
    train, test = pr.train_test_split(ratings(spark, sf_dir))
    s = cosine_similarity(train, axis="cols", epsilon=EPS, include_diagonal=True, row_bound=CF_Q.top_n)
    return r6(pr.mse(pr.predict_at(train, s, test, "item"), test), "mse")


# --- serving tables and lookups -----------------------------------------------------------


CF_PROFILE_K = CF_K - 1  # k related with the item itself removed


def cf_profile(md: ActivityModel) -> DataFrame:
    rel = top_k_per_row(cf.item_similarity(md), CF_PROFILE_K, names=md.item_names,
                        name_bound=md.band.top_n)
    return sv.item_profile(rel, md.top)


def stored(spark, df: DataFrame, name: str) -> DataFrame:
    """Write a serving table to a fresh folder under the shared checkpoint dir, read it back."""
    path = scratch_dir(spark, name)
    sv.write_table(df, path)
    return sv.read_table(spark, path)


def stored_profile(spark, sf_dir) -> DataFrame:
    return stored(spark, cf_profile(model(spark, sf_dir)), "item_profile")


def stored_history(spark, sf_dir) -> DataFrame:
    return stored(spark, sv.user_history(model(spark, sf_dir).kept_nonzero), "user_history")


@query("item_profile")
def q_item_profile(spark, sf_dir):
    return stored_profile(spark, sf_dir).select("item", "activity",
                                                F.array_join("related", ",").alias("related"))


@query("user_history")
def q_user_history(spark, sf_dir):
    return stored_history(spark, sf_dir).select("user", F.array_join("items", ",").alias("items"))


@query("serving_roundtrip")
def q_serving_roundtrip(spark, sf_dir):
    prof, hist = stored_profile(spark, sf_dir), stored_history(spark, sf_dir)
    visits = hist.select("user", F.explode("items").alias("item"))
    return visits.join(prof, "item").select("user", "item", "activity",
                                            F.size("related").cast("bigint").alias("n_related"))


def keyed(spark, df: DataFrame, key: str, name: str) -> store.KeyedTable:
    """Write a keyed serving table to a fresh folder under the shared checkpoint dir."""
    return store.create(df, scratch_dir(spark, name), key)


@query("serving_requests")
def q_serving_requests(spark, sf_dir):
    """The stored history of every customer; customers outside the band have none."""
    table = keyed(spark, sv.user_history(model(spark, sf_dir).kept_nonzero), "user", "history")
    asked = read_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("user"))
    return table.join_requests(asked).select("user", F.array_join("items", ",").alias("items"))


EMPTIED_ITEMS = 10


@query("serving_insert_empty")
def q_serving_insert_empty(spark, sf_dir):
    """The CF profile after its ten most active items were emptied, the items of the event
    log inserted and the tenth item inserted again without related ones."""
    md = model(spark, sf_dir)
    table = keyed(spark, cf_profile(md), "item", "profile")
    table.remove(md.top.where(F.col("item_id") <= EMPTIED_ITEMS).select("item"))
    events = item_activity(model(spark, sf_dir, adapter="events", band=EVENTS_Q).occ_nonzero)
    again = md.top.where(F.col("item_id") == EMPTIED_ITEMS)
    table.insert(events.select("item", "activity").unionByName(again.select("item", "activity"))
                 .withColumn("related", F.array().cast("array<string>")))
    return table.read(spark).select("item", "activity", F.array_join("related", ",").alias("related"))


@query("serving_lookup")
def q_serving_lookup(spark, sf_dir):
    """Profiles of the three most active items (and of one unknown name), one bucket each."""
    md = model(spark, sf_dir)
    table = keyed(spark, cf_profile(md), "item", "profile")
    names = [r.item for r in md.top.where(F.col("item_id") <= 3).select("item").collect()]
    return table.lookup(spark, [*names, "no-such-item"]).select(
        "item", "activity", F.array_join("related", ",").alias("related"))


def _bag(spark, sf_dir) -> DataFrame:
    md = model(spark, sf_dir)
    return sv.candidate_bag(sv.user_history(md.kept_nonzero), cf_profile(md))


@query("candidate_bag")
def q_candidate_bag(spark, sf_dir):
    return sv.bag_multiplicity(_bag(spark, sf_dir))


@query("recommend_for_user_sampled")
def q_recommend_for_user_sampled(spark, sf_dir):
    return sv.recommend_sampled(_bag(spark, sf_dir))


@query("recommend_for_user_ranked")
def q_recommend_for_user_ranked(spark, sf_dir):
    return sv.recommend_ranked(_bag(spark, sf_dir))


def _item_requests(md: ActivityModel) -> DataFrame:
    empty = md.top.limit(1).select(F.lit("").alias("item"))
    return _requests(md, 2).unionByName(empty)


@query("related_answer_text")
def q_related_answer_text(spark, sf_dir):
    md = model(spark, sf_dir)
    return sv.related_answers(_item_requests(md), cf_profile(md))


@query("recommend_answer_text")
def q_recommend_answer_text(spark, sf_dir):
    md = model(spark, sf_dir)
    known = md.users.orderBy(F.desc("n_items"), F.asc("user")).limit(2).select("user")
    extra = md.top.limit(1).select(F.lit("no-such-user").alias("user")).unionByName(
        md.top.limit(1).select(F.lit("").alias("user")))
    picks = sv.recommend_ranked(_bag(spark, sf_dir)).withColumnRenamed("rk", "pick")
    return sv.recommendation_answers(known.unionByName(extra), picks)


@query("related_as_text")
def q_related_as_text(spark, sf_dir):
    return cf_profile(model(spark, sf_dir)).select("item", tx.lines(F.col("related")).alias("text"))


@query("item_link")
def q_item_link(spark, sf_dir):
    return model(spark, sf_dir).top.select("item", tx.item_link(F.col("item")).alias("link"))


@query("items_of_user")
def q_items_of_user(spark, sf_dir):
    md = model(spark, sf_dir)
    one = md.users.orderBy(F.desc("n_items"), F.asc("user")).limit(1)
    return sv.items_of_user(md.occ_nonzero, one).select("user", "item", "comments")


@query("activity_all_users")
def q_activity_all_users(spark, sf_dir):
    md = model(spark, sf_dir)
    return sv.activity_all_users(md.occ_nonzero, md.kept_nonzero).select("user", "item", "comments", "item_id", "copies")


@query("activity_all_users_semi")
def q_activity_all_users_semi(spark, sf_dir):
    md = model(spark, sf_dir)
    return sv.activity_all_users_semi(md.occ_nonzero, md.kept_nonzero).select("user", "item", "comments")


# --- sources and sinks ----------------------------------------------------------------------


TEEN_SQL = "SELECT name FROM people WHERE age >= :lo AND age <= :hi"


@query("scan_json_log")
def q_scan_json_log(spark, sf_dir):
    path = scratch_dir(spark, "json_log")
    fs.write_json(log_from_events(spark, sf_dir), path)
    return fs.read_json_log(spark, path)


@query("scan_json_nested")
def q_scan_json_nested(spark, sf_dir):
    path = scratch_dir(spark, "json_nested")
    od = read_table(spark, sf_dir, "orders")
    fs.write_json(od.select(F.col("o_orderkey").alias("f1"), F.col("o_orderstatus").alias("f2"),
                            F.struct(F.col("o_custkey").alias("field4")).alias("f3")), path)
    return fs.read_json_inferred(spark, path).select("f1", "f2", F.col("f3.field4").alias("field4"))


@query("rows_nested_types")
def q_rows_nested_types(spark, sf_dir):
    """Array, nested array, map, set and tuple columns per user, flattened by explode."""
    pr_ = model(spark, sf_dir).kept_nonzero
    nested = pr_.groupBy("user").agg(
        F.sort_array(F.collect_list("item_id")).alias("f1"),
        F.map_from_entries(F.collect_list(F.struct("item", F.col("net_score").cast("double")))).alias("f2"),
        F.array_distinct(F.collect_list(F.signum("net_score").cast("bigint"))).alias("f_set"),
        F.struct(F.min("item_id").alias("lo"), F.max("item_id").alias("hi")).alias("f_tuple"))
    nested = nested.withColumn("f3", F.transform("f1", lambda x: F.array(x, x * 2)))
    return nested.select(
        "user", F.explode("f2").alias("item", "score"),
        F.size("f1").cast("bigint").alias("n_items"),
        F.size(F.flatten("f3")).cast("bigint").alias("n_nested"),
        F.size("f_set").cast("bigint").alias("n_signs"),
        F.col("f_tuple.lo").alias("lo"), F.col("f_tuple.hi").alias("hi"))


def _people(spark, sf_dir) -> DataFrame:
    path = scratch_dir(spark, "people")
    cust = read_table(spark, sf_dir, "customer")
    fs.write_delimited(cust.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("age")), path)
    return fs.read_people(spark, path)


@query("scan_delimited_text")
def q_scan_delimited_text(spark, sf_dir):
    return _people(spark, sf_dir)


def _teenagers(spark, sf_dir) -> DataFrame:
    _people(spark, sf_dir).createOrReplaceTempView("people")
    return spark.sql(TEEN_SQL, args={"lo": 13, "hi": 19})


@query("sql_range_filter")
def q_sql_range_filter(spark, sf_dir):
    return _teenagers(spark, sf_dir)


@query("string_projection")
def q_string_projection(spark, sf_dir):
    return _teenagers(spark, sf_dir).select(F.concat(F.lit("Name: "), F.col("name")).alias("text"))


@query("scan_csv_ratings")
def q_scan_csv_ratings(spark, sf_dir):
    path = scratch_dir(spark, "ratings_csv")
    r = ratings(spark, sf_dir)
    fs.write_delimited(r.select(F.col("i").alias("user"), F.col("j").alias("item"), F.col("value").alias("rating")),
                       path)
    return fs.read_ratings(spark, path)


@query("scan_csv_users")
def q_scan_csv_users(spark, sf_dir):
    path = scratch_dir(spark, "users_csv")
    fs.write_delimited(q_split_test(spark, sf_dir).select(F.col("i").alias("user")), path)
    return fs.read_target_users(spark, path)


@query("seen_items_by_user")
def q_seen_items_by_user(spark, sf_dir):
    path = scratch_dir(spark, "seen_csv")
    fs.write_delimited(q_split_train(spark, sf_dir).select(F.col("i").alias("user"), F.col("j").alias("item")), path)
    seen = fs.read_seen_items(spark, path)
    return seen.select("user", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"))


@query("parquet_roundtrip")
def q_parquet_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "pruned_parquet")
    fs.write_parquet(q_pruned_activity(spark, sf_dir), path)
    return fs.read_parquet(spark, path)


# --- CF batch, model comparison, CF recommendations --------------------------------------------



@query("cf_batch")
def q_cf_batch(spark, sf_dir):
    """End-to-end CF batch with the reference's CF band: log -> profile table (stored, read back)."""
    md = model(spark, sf_dir, band=CF_BAND)
    prof = stored(spark, cf_profile(md), "cf_profile")
    return prof.select("item", "activity", F.array_join("related", ",").alias("related"))


def _std_train_similarity(r: DataFrame) -> DataFrame:
    train, _ = pr.train_test_split(mx.scale_columns_to_unit_std(r, col_bound=CF_Q.top_n))
    return cosine_similarity(train, axis="cols", epsilon=EPS, include_diagonal=True, row_bound=CF_Q.top_n)


@query("compare_models")
def q_compare_models(spark, sf_dir):
    """Top 10 related of the most active item under three similarity models."""
    md = model(spark, sf_dir)
    m = md.matrix
    sims = {
        "cf": cosine_similarity(m, row_bound=CF_Q.top_n),
        "cf_eps": cosine_similarity(m, epsilon=EPS, row_bound=CF_Q.top_n),
        "cf_std": _std_train_similarity(mx.transpose(m)),
    }
    first = md.top.where(F.col("item_id") == 1).select("item")
    out = None
    for name, s in sims.items():
        t = top_k_per_row(s, CF_K, names=md.item_names, name_bound=CF_Q.top_n)
        t = t.join(F.broadcast(first), "item", "left_semi").select(F.lit(name).alias("model"), "*")
        out = t if out is None else out.unionByName(t)
    return out


@query("recommend_unseen")
def q_recommend_unseen(spark, sf_dir):
    """CF scores ``R . S`` per user, top 250, minus seen items, first 5."""
    from pyspark.sql import Window
    md = model(spark, sf_dir)
    r = ratings(spark, sf_dir)
    s = cosine_similarity(md.matrix, row_bound=CF_Q.top_n)
    scores = mx.multiply(r, s).select(F.col("i").alias("uid"), "j", F.round("value", 6).alias("score"))
    names = F.broadcast(md.item_names.select(F.col("i").alias("j"), "item"))
    w = Window.partitionBy("uid").orderBy(F.desc("score"), F.asc("item"))
    top = scores.join(names, "j").withColumn("rk0", F.row_number().over(w)).where(F.col("rk0") <= 250)
    unseen = top.join(r.select(F.col("i").alias("uid"), "j"), ["uid", "j"], "left_anti")
    w2 = Window.partitionBy("uid").orderBy("rk0")
    return (unseen.withColumn("rk", F.row_number().over(w2).cast("bigint")).where(F.col("rk") <= 5)
                  .select("uid", "rk", "item", "score"))


@query("vector_neighbors")
def q_vector_neighbors(spark, sf_dir):
    """Every embedding with its cosine to the query embedding (smallest vec_id), descending."""
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return fc.rank_by_cosine(emb, "vec_id", "embedding", emb.agg(F.min("vec_id")).scalar())


@query("vector_neighbors_topk")
def q_vector_neighbors_topk(spark, sf_dir):
    """The ten closest embeddings of every embedding whose id is divisible by 100, by a pivot table."""
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asked = emb.where(F.col("vec_id") % 100 == 0).withColumnRenamed("vec_id", "request")
    pairs = pv.scored_pairs(emb, asked, "vec_id", "request", "embedding", CF_K, exclude_same=True)
    return pv.top_k(pairs, CF_K).select("request", "rk", F.col("key").alias("vec_id"), F.round("sim", 6).alias("sim"))


# --- LSA: SVD, latent space -------------------------------------------------------------------------


LSA_Q = lsa.LSA_BAND
LSA_K_Q = lsa.LSA_K

_FACTORS: dict[tuple, fc.Factors] = {}
_SERVED: dict[tuple, tuple[store.KeyedTable, store.KeyedTable]] = {}


def lsa_model(spark, sf_dir) -> ActivityModel:
    return model(spark, sf_dir, band=lsa.LSA_BAND)


def lsa_factors(spark, sf_dir, rank: int | None = lsa.LSA_RANK) -> fc.Factors:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), rank)
    if key not in _FACTORS:
        _FACTORS[key] = lsa.factors(lsa_model(spark, sf_dir), rank)
    return _FACTORS[key]


@query("svd_energy")
def q_svd_energy(spark, sf_dir):
    """Sum of squared singular values at full rank (= squared Frobenius norm)."""
    total = fc.energy(lsa.weighted_matrix(model(spark, sf_dir, band=LSA_Q)))
    return spark.createDataFrame([(round(total, 4),)], "energy double")


@query("svd_factors")
def q_svd_factors(spark, sf_dir):
    f = lsa_factors(spark, sf_dir)
    names = lsa_model(spark, sf_dir).item_names
    sv_ = fc.singular_values_frame(spark, f)
    return (fc.factors_long(spark, f).join(F.broadcast(names), "i").join(F.broadcast(sv_), "d")
              .select("item", "d", F.round("u", 9).alias("u"), F.round("s", 9).alias("s")))


# The ranks that the reference tries, and some small ones between them.
SWEEP_RANKS = (2, 3, 5, 10, 20, 50, 75, 90, 100, 150, 200, 300, 470, 500)


@query("svd_rank_sweep")
def q_svd_rank_sweep(spark, sf_dir):
    """Share of the energy kept by rank k, for all ranks tried by the reference that are not above the
    number of items. Beyond the rank of the matrix nothing is added."""
    f = lsa_factors(spark, sf_dir, max(SWEEP_RANKS))
    total = fc.energy(lsa.weighted_matrix(lsa_model(spark, sf_dir)))
    rows = [(k, float(np.sum(f.s[:k] ** 2)), float(np.sum(f.s[:k] ** 2) / total))
            for k in SWEEP_RANKS if k <= len(f.index)]
    return spark.createDataFrame(rows, "k long, energy double, fraction double")


@query("latent_similarity_topk")
def q_latent_similarity_topk(spark, sf_dir):
    return lsa.related(spark, lsa_model(spark, sf_dir), lsa_factors(spark, sf_dir), LSA_K_Q)


def _user_entries(spark, sf_dir) -> DataFrame:
    """Weighted entries of the users' rows over the item index: ``(row, i, value)``."""
    a = lsa.weighted_matrix(lsa_model(spark, sf_dir))
    return a.select(F.col("j").alias("row"), "i", "value")


@query("fold_in_rows")
def q_fold_in_rows(spark, sf_dir):
    """Users folded into the latent space: ``(w * ln(1 + x)) . U . S^-1`` with ``S = sqrt(s)``."""
    f = lsa_factors(spark, sf_dir)
    folded = fc.fold_in_vectors(spark, _user_entries(spark, sf_dir), f, -fc.LATENT_POWER)
    return (folded.select(F.col("row").alias("uid"), F.posexplode("vector").alias("d", "value"))
                  .select("uid", F.col("d").cast("bigint").alias("d"), F.round("value", 9).alias("value")))


@query("latent_neighbors")
def q_latent_neighbors(spark, sf_dir):
    """For every folded-in user, all items by cosine in the latent space, closest first."""
    f = lsa_factors(spark, sf_dir)
    q = fc.fold_in_vectors(spark, _user_entries(spark, sf_dir), f, -fc.LATENT_POWER)
    top = fc.score_topk(spark, q, f, len(f.index), 0.0, mode="cosine")
    names = F.broadcast(lsa_model(spark, sf_dir).item_names)
    return top.join(names, "i").select(F.col("row").alias("uid"), "rk", "item", F.col("score").alias("sim"))


@query("latent_neighbors_topk")
def q_latent_neighbors_topk(spark, sf_dir):
    """The first of ``latent_neighbors`` for every folded-in user, without ranking all items."""
    f = lsa_factors(spark, sf_dir)
    asked = fc.fold_in_vectors(spark, _user_entries(spark, sf_dir), f, -fc.LATENT_POWER)
    pairs = pv.scored_pairs(fc.factors_frame(spark, f), asked, "i", "row", "vector", LSA_K_Q)
    top = pv.top_k(pairs, LSA_K_Q).withColumnRenamed("key", "i")
    names = F.broadcast(lsa_model(spark, sf_dir).item_names)
    return top.join(names, "i").select(F.col("request").alias("uid"), "rk", "item", "sim")


@query("svd_recommend_unseen")
def q_svd_recommend_unseen(spark, sf_dir):
    """Estimated ratings ``U[u] S V^T`` per user: top 250 items, minus seen, first 5."""
    from pyspark.sql import Window
    f = lsa_factors(spark, sf_dir)
    entries = _user_entries(spark, sf_dir)
    q = fc.fold_in_vectors(spark, entries, f, 0.0)
    top = fc.score_topk(spark, q, f, 250, -fc.LATENT_POWER, mode="dot")
    unseen = top.join(entries.select("row", "i"), ["row", "i"], "left_anti")
    w = Window.partitionBy("row").orderBy("rk")
    names = F.broadcast(lsa_model(spark, sf_dir).item_names)
    return (unseen.withColumn("pick", F.row_number().over(w).cast("bigint")).where(F.col("pick") <= 5)
                  .join(names, "i").select(F.col("row").alias("uid"), F.col("pick").alias("rk"), "item", "score"))


def lsa_profile(spark, sf_dir) -> DataFrame:
    md = lsa_model(spark, sf_dir)
    f = lsa_factors(spark, sf_dir)
    return sv.item_profile(lsa.related(spark, md, f, LSA_K_Q - 1), md.top, lsa.vectors(spark, md, f))


@query("projection_2d")
def q_projection_2d(spark, sf_dir):
    """2-D map from the stored LSA profile; the most active item is the excluded outlier."""
    prof = stored(spark, lsa_profile(spark, sf_dir), "lsa_profile")
    outlier = lsa_model(spark, sf_dir).top.where(F.col("item_id") == 1).select("item")
    return sv.projection_2d(prof, exclude=outlier)


# --- look-ups over the LSA profile, the table that is served --------------------------------------


def _lsa_served(spark, sf_dir) -> tuple[store.KeyedTable, store.KeyedTable]:
    """The stored LSA profile and the histories of its band, both keyed; one pair per model."""
    md = lsa_model(spark, sf_dir)
    own = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if own not in _SERVED:
        _SERVED[own] = (keyed(spark, lsa_profile(spark, sf_dir), "item", "lsa_profile"),
                        keyed(spark, sv.user_history(md.kept_nonzero), "user", "lsa_history"))
    return _SERVED[own]


def _lsa_bag(spark, sf_dir) -> DataFrame:
    prof, hist = _lsa_served(spark, sf_dir)
    return sv.candidate_bag(hist.read(spark), prof.read(spark))


@query("lsa_serving_roundtrip")
def q_lsa_serving_roundtrip(spark, sf_dir):
    """Both served tables read back in full: per user and visited item its profile."""
    prof, hist = _lsa_served(spark, sf_dir)
    visits = hist.read(spark).select("user", F.explode("items").alias("item"))
    return visits.join(prof.read(spark), "item").select(
        "user", "item", "activity", F.size("related").cast("bigint").alias("n_related"),
        F.size("vector").cast("bigint").alias("dims"))


@query("lsa_candidate_bag")
def q_lsa_candidate_bag(spark, sf_dir):
    return sv.bag_multiplicity(_lsa_bag(spark, sf_dir))


@query("lsa_recommend_sampled")
def q_lsa_recommend_sampled(spark, sf_dir):
    return sv.recommend_sampled(_lsa_bag(spark, sf_dir))


@query("lsa_recommend_ranked")
def q_lsa_recommend_ranked(spark, sf_dir):
    return sv.recommend_ranked(_lsa_bag(spark, sf_dir))


@query("lsa_related_answer_text")
def q_lsa_related_answer_text(spark, sf_dir):
    prof, _ = _lsa_served(spark, sf_dir)
    return sv.related_answers(_item_requests(lsa_model(spark, sf_dir)), prof.read(spark))


@query("leading_singular_value")
def q_leading_singular_value(spark, sf_dir):
    return fc.leading_singular_value(lsa.weighted_matrix(lsa_model(spark, sf_dir)))


@query("leading_singular_vectors")
def q_leading_singular_vectors(spark, sf_dir):
    """Both vectors and the value of the leading triple: ``side`` item (index i) or user (index j)."""
    t = leading_triple(lsa.weighted_matrix(lsa_model(spark, sf_dir)))
    sides = [d.select(F.lit(side).alias("side"), F.col(key).alias("id"), F.round("value", 6).alias("value"))
             for d, key, side in ((t.u, "i", "item"), (t.v, "j", "user"))]
    return sides[0].unionByName(sides[1]).withColumn("sigma", F.lit(round(t.sigma, 6)))


@query("latent_similarity_plain")
def q_latent_similarity_plain(spark, sf_dir):
    """Top related by the plain product of the factors scaled by the singular values."""
    f = lsa_factors(spark, sf_dir)
    return fc.latent_similarity_topk(spark, f, LSA_K_Q, normalize=False, power=1.0).withColumn(
        "sim", F.round("sim", 4))


@query("latent_similarity_scaled")
def q_latent_similarity_scaled(spark, sf_dir):
    """Top related by cosine of the factors scaled by the singular values."""
    f = lsa_factors(spark, sf_dir)
    return fc.latent_similarity_topk(spark, f, LSA_K_Q, power=1.0).withColumn("sim", F.round("sim", 6))


@query("vector_from_dense")
def q_vector_from_dense(spark, sf_dir):
    """The embedding with the smallest id as a sparse vector."""
    e = read_table(spark, sf_dir, "embeddings").where("vec_id is not null and embedding is not null")
    return r9(mx.vector_from_dense(e.orderBy("vec_id").limit(1), "embedding"))


@query("lsa_batch")
def q_lsa_batch(spark, sf_dir):
    """End-to-end LSA batch: log -> weighted matrix -> SVD -> profile (stored, read back)."""
    prof = stored(spark, lsa_profile(spark, sf_dir), "lsa_profile")
    return prof.select("item", "activity", F.array_join("related", ",").alias("related"),
                       F.size("vector").cast("bigint").alias("dims"))


@query("max_encoded_length")
def q_max_encoded_length(spark, sf_dir):
    prof = lsa_profile(spark, sf_dir)
    return prof.agg(F.max(F.length(F.to_json("vector"))).cast("bigint").alias("max_length"))
