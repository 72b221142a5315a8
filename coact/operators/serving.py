"""Serving tables and the three lookups, as joins of request DataFrames.

* item profile ``(item, activity, related array<string>[, vector array<double>])``
* user history ``(user, items array<string>)``
* related-items answers, user recommendations (sampled or ranked) and the
  2-D map of items.

A lookup joins a DataFrame of requests with the stored tables, so one job
answers many keys.  Every per-key list here is bounded by a parameter: an
item's related list by ``k``, a user's history by the activity band, a user's
candidate bag by (history x k).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coact.functions.scalar import safe_div
from coact.functions import text as tx

SAMPLE_SEED = 42
RECOMMEND_N = 20
PLOT_SCALE = 5e-2


def ordered_list(value: str, order: str) -> Column:
    """``collect_list(value)`` in ``order`` (sort an array of structs, keep one field)."""
    return F.transform(F.sort_array(F.collect_list(F.struct(F.col(order), F.col(value)))),
                       lambda s: s[value])


def item_profile(related: DataFrame, activity: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """One row per item: activity, related names in rank order, optional latent vector.

    ``related``: ``item, related, rk``; ``activity``: ``item, activity``;
    ``vectors``: ``item, vector``.  Items without any related entry keep an
    empty list.
    """
    lists = related.groupBy("item").agg(ordered_list("related", "rk").alias("related"))
    prof = activity.select("item", "activity").join(lists, "item", "left").select(
        "item", "activity", F.coalesce("related", F.array().cast("array<string>")).alias("related"))
    if vectors is not None:
        prof = prof.join(vectors.select("item", "vector"), "item", "left")
    return prof


def user_history(pruned: DataFrame) -> DataFrame:
    """Visited items of every user, sorted (bounded by the activity band)."""
    return pruned.groupBy("user").agg(F.sort_array(F.collect_set("item")).alias("items"))


def write_table(df: DataFrame, path: str) -> None:
    """Overwrite a serving table (overwrite = empty + insert)."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def candidate_bag(history: DataFrame, profile: DataFrame) -> DataFrame:
    """Bag of the related lists of every visited item (duplicates kept).

    ``user, visited, vpos, rpos, candidate``; visited items missing from the
    profile are skipped (inner join).
    """
    visits = history.select("user", F.posexplode("items").alias("vpos", "visited"))
    rel = profile.select(F.col("item").alias("visited"), "related")
    return (visits.join(rel, "visited")
                  .select("user", "visited", "vpos", F.posexplode("related").alias("rpos", "candidate")))


def bag_multiplicity(bag: DataFrame) -> DataFrame:
    return bag.groupBy("user", "candidate").agg(F.count(F.lit(1)).cast("bigint").alias("copies"))


def recommend_sampled(bag: DataFrame, n: int = RECOMMEND_N, seed: int = SAMPLE_SEED,
                      exclude_visited: DataFrame | None = None) -> DataFrame:
    """Draw ``n`` bag entries per user without replacement (reproducible by seed).

    Duplicate names may be drawn (they are distinct bag entries, as in the
    reference); a bag smaller than ``n`` gives what there is.
    """
    from pyspark.sql import Window
    if exclude_visited is not None:
        seen = exclude_visited.select("user", F.explode("items").alias("candidate"))
        bag = bag.join(seen, ["user", "candidate"], "left_anti")
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("user"), F.col("visited"),
                            F.col("rpos").cast("string")))
    w = Window.partitionBy("user").orderBy(key, F.col("vpos"), F.col("rpos"))
    return (bag.withColumn("pick", F.row_number().over(w).cast("bigint"))
               .where(F.col("pick") <= n).select("user", "pick", "candidate"))


def recommend_ranked(bag: DataFrame, n: int = RECOMMEND_N, exclude_visited: DataFrame | None = None) -> DataFrame:
    """The ``n`` most frequent distinct candidates per user (ties by name)."""
    from pyspark.sql import Window
    counts = bag_multiplicity(bag)
    if exclude_visited is not None:
        seen = exclude_visited.select("user", F.explode("items").alias("candidate"))
        counts = counts.join(seen, ["user", "candidate"], "left_anti")
    w = Window.partitionBy("user").orderBy(F.desc("copies"), F.asc("candidate"))
    return (counts.withColumn("rk", F.row_number().over(w).cast("bigint"))
                  .where(F.col("rk") <= n).select("user", "rk", "candidate", "copies"))


def related_answers(requests: DataFrame, profile: DataFrame) -> DataFrame:
    """``request, answer`` text for every requested item name."""
    prof = profile.select(F.col("item").alias("request"), "related")
    return requests.select(F.col("item").alias("request")).join(prof, "request", "left").select(
        "request", tx.related_answer(F.col("request"), F.col("related")).alias("answer"))


def recommendation_answers(requests: DataFrame, picks: DataFrame) -> DataFrame:
    """``request, answer`` text for every requested user (picks: user, pick, candidate)."""
    lists = picks.groupBy("user").agg(ordered_list("candidate", "pick").alias("picks"))
    return requests.select(F.col("user").alias("request")).join(
        lists.withColumnRenamed("user", "request"), "request", "left").select(
        "request", tx.recommendation_answer(F.col("request"), F.col("picks")).alias("answer"))


def projection_2d(profile: DataFrame, exclude: DataFrame | None = None,
                  components: tuple[int, int] = (0, 1), scale: float = PLOT_SCALE) -> DataFrame:
    """Scatter points ``item, x, y, size`` from the latent vectors.

    Zero vectors are left out. ``x``/``y`` are two leading components divided by the vector norm and
    shifted so their minimum is 0; ``size = scale * sqrt(activity)``.  Items in
    ``exclude`` (e.g. one dominating outlier) are left out before the shift.
    """
    p = profile.where(F.col("vector").isNotNull())
    if exclude is not None:
        p = p.join(exclude.select("item"), "item", "left_anti")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    pts = p.select("item", "activity", safe_div(F.col("vector")[components[0]], norm).alias("x0"),
                   safe_div(F.col("vector")[components[1]], norm).alias("y0")).where(F.col("x0").isNotNull())
    mins = pts.agg(F.min("x0").alias("mx"), F.min("y0").alias("my"))
    return pts.select("item", (F.col("x0") - mins.select("mx").scalar()).alias("x"),
                      (F.col("y0") - mins.select("my").scalar()).alias("y"),
                      (F.lit(scale) * F.sqrt(F.col("activity").cast("double"))).alias("size"))


def items_of_user(occ: DataFrame, users: DataFrame | str) -> DataFrame:
    """Items (and activity) of the requested user(s): a literal or a DataFrame of users."""
    if isinstance(users, str):
        return occ.where(F.col("user") == F.lit(users))
    return occ.join(users.select("user"), "user", "left_semi")


def activity_all_users(occ: DataFrame, pruned: DataFrame) -> DataFrame:
    """All activity of the kept items with the fan-out multiplicity, without the fan-out.

    The reference's many-to-many join repeats every (user, item) row once per
    pruned user of the item; here the repetition count is joined instead
    (``copies``), which is the same bag in aggregated form.
    """
    per_item = pruned.groupBy("item", "item_id").agg(F.count(F.lit(1)).cast("bigint").alias("copies"))
    return occ.join(per_item, "item")


def activity_all_users_semi(occ: DataFrame, pruned: DataFrame) -> DataFrame:
    return occ.join(pruned.select("item").distinct(), "item", "left_semi")
