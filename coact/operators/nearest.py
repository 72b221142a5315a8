"""Exact top-k cosine neighbours of every row without comparing all pairs.

All co-active pairs of users are quadratic in a popular item's audience. Here a
row only meets the rows that can still enter its k best:

1. *Weights and order.* A row is scaled to length 1 and its entries are ordered by
   the audience of their column, rarest first. ``rest`` is the length of what
   follows an entry in that order.
2. *Floors.* Every row is scored exactly against a few heavy entries of its own
   heaviest columns. The k-th best of these scores is a lower bound of the row's
   k-th best similarity. They are real scores, so the choice of seeds changes
   the work and never the result.
3. *Inverted index with maximum weights.* The entries of a column are split into
   classes of similar weight; for each class the index knows the largest and the
   smallest weight and the largest ``rest``. If an entry (u, c) is the first
   column that u shares with v, then by Cauchy-Schwarz

       cos(u, v) <= w_uc * w_vc + rest_uc * rest_vc.

   So u visits only the classes whose bound reaches its floor, and in a class it
   keeps only the rows whose own bound does. A partner that belongs to the k best
   passes at the first shared column; passing elsewhere as well does no harm.
   Entries whose bound fails everywhere are never sent: what is left of a row is
   its prefix, and popular columns, which come last, rarely are in it.
4. *Verification.* The remaining pairs are scored exactly from both rows.

Popular columns: weights are attached and classes are joined heavy / light
(:mod:`coact.operators.skew`). A row is held whole (one packed row), so rows must
be bounded, as the activity band's ``max_items`` bounds a user's.

Defined results: only pairs that share a column count, as in
:func:`coact.operators.similarity.cosine_similarity`; a row with fewer than k such
partners gets them all, whatever their sign; equal similarities (after rounding)
go to the smaller id; zero entries and rows without any other entry take no
part; duplicate coordinates are summed; an empty matrix gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coact.operators.similarity import SIM_DIGITS, _orient, top_k_per_row
from coact.operators.skew import FLOOR, SHARE, join_groups, join_many
from coact.session import scratch_dir

CLASSES = 8              # weight classes on either side of zero
SEED_COLUMNS = 4         # a row's heaviest columns that are looked at for its floor
SLACK = 2 * 10.0 ** -SIM_DIGITS     # bounds this much below the floor cannot tie with it after rounding
NO_FLOOR = -2.0          # below every cosine: nothing is ruled out


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def weighted_entries(m: DataFrame, share: int = SHARE, floor: int = FLOOR) -> DataFrame:
    """``(i, k, value, norm, w, rest)`` for every non-zero entry of the rows of ``m``, staged."""
    e = (m.where(F.col("i").isNotNull() & F.col("j").isNotNull())
         .groupBy("i", F.col("j").alias("k")).agg(F.sum("value").alias("value")).where(F.col("value") != 0))
    e = _staged(e, "nearest-entries")
    audience = e.groupBy("k").agg(F.count("*").alias("n"))
    sized = join_groups(e, audience, ["k"], "n", e.count(), share=share, floor=floor)
    row = Window.partitionBy("i")
    after = row.orderBy(F.col("n"), F.col("k")).rowsBetween(1, Window.unboundedFollowing)
    w = F.col("value") / F.col("norm")
    return _staged(sized.withColumn("norm", F.sqrt(F.sum(F.col("value") * F.col("value")).over(row)))
                   .withColumn("w", w)
                   .withColumn("rest", F.sqrt(F.coalesce(F.sum(F.col("w") * F.col("w")).over(after), F.lit(0.0))))
                   .select("i", "k", "value", "norm", "w", "rest"), "nearest-weights")


def exact(pairs: DataFrame, e: DataFrame) -> DataFrame:
    """``(i, j, value)``: the cosine of each of the pairs ``(i, j)``, from both whole rows."""
    rows = e.groupBy("i").agg(F.map_from_entries(F.collect_list(F.struct("k", "value"))).alias("row"),
                              F.first("norm").alias("norm"))
    dot = F.aggregate(F.map_entries("row"), F.lit(0.0),
                      lambda s, x: s + x["value"] * F.coalesce(F.try_element_at(F.col("other"), x["key"]), F.lit(0.0)))
    other = rows.select(F.col("i").alias("j"), F.col("row").alias("other"), F.col("norm").alias("other_norm"))
    return (pairs.join(rows, "i").join(other, "j")
            .select("i", "j", (dot / F.col("norm") / F.col("other_norm")).alias("value")))


def floors(e: DataFrame, k: int, share: int = SHARE, floor: int = FLOOR) -> DataFrame:
    """``(i, least)``: a lower bound of each row's k-th best cosine, staged."""
    side = F.when(F.col("w") > 0, 1).otherwise(0)
    signed = e.withColumn("side", side)
    best = Window.partitionBy("k", "side").orderBy(F.abs("w").desc(), F.col("i"))
    seeds = (signed.withColumn("r", F.row_number().over(best)).where(F.col("r") <= 2 * k)
             .groupBy("k", "side").agg(F.collect_list("i").alias("seeds")))
    sizes = signed.groupBy("k", "side").agg(F.count("*").alias("n"))
    heaviest = Window.partitionBy("i").orderBy(F.abs("w").desc(), F.col("k"))
    asked = (signed.withColumn("r", F.row_number().over(heaviest)).where(F.col("r") <= SEED_COLUMNS)
             .select("i", "k", "side"))
    pairs = (join_groups(asked, seeds.join(sizes, ["k", "side"]), ["k", "side"], "n", e.count(),
                         share=share, floor=floor)
             .select("i", F.explode("seeds").alias("j")).where(F.col("i") != F.col("j")).distinct())
    ranked = Window.partitionBy("i").orderBy(F.col("value").desc())
    kth = (exact(pairs, e).withColumn("r", F.row_number().over(ranked)).where(F.col("r") == k)
           .select("i", F.col("value").alias("least")))
    return _staged(e.select("i").distinct().join(kth, "i", "left")
                   .select("i", F.coalesce("least", F.lit(NO_FLOOR)).alias("least")), "nearest-floors")


def candidates(e: DataFrame, least: DataFrame, share: int = SHARE, floor: int = FLOOR) -> DataFrame:
    """Distinct ordered pairs ``(i, j)`` that may belong to the k best of ``i``."""
    level = F.floor(F.col("w") * CLASSES).cast("int")
    index = e.select("k", level.alias("level"), F.col("i").alias("j"), F.col("w").alias("wv"),
                     F.col("rest").alias("rv"))
    # at most 2 * CLASSES + 1 classes a column, so one packed row a column
    classes = (index.groupBy("k", "level").agg(F.max("wv").alias("hi"), F.min("wv").alias("lo"),
                                               F.max("rv").alias("rest"), F.count("*").alias("n"))
               .groupBy("k").agg(F.collect_list(F.struct("level", "hi", "lo", "rest")).alias("classes"),
                                 F.sum("n").alias("n")))
    probes = e.select("i", "k", F.col("w").alias("wu"), F.col("rest").alias("ru")).join(least, "i")
    reach = F.col("least") - F.lit(SLACK)

    def may(x):
        return F.greatest(F.col("wu") * x["hi"], F.col("wu") * x["lo"]) + F.col("ru") * x["rest"] >= reach

    probes = (join_groups(probes, classes, ["k"], "n", e.count(), share=share, floor=floor)
              .select("i", "k", "wu", "ru", "least", F.explode(F.filter("classes", may)).alias("c"))
              .select("i", F.struct("k", F.col("c.level").alias("level")).alias("at"), "wu", "ru", "least"))
    entries = index.select(F.struct("k", "level").alias("at"), "j", "wv", "rv")
    return (join_many(probes, entries, "at", share=share, floor=floor)
            .where((F.col("i") != F.col("j"))
                   & (F.col("wu") * F.col("wv") + F.col("ru") * F.col("rv") >= reach))
            .select("i", "j").distinct())


def top_k_neighbours(m: DataFrame, k: int, axis: str = "rows", share: int = SHARE,
                     floor: int = FLOOR) -> DataFrame:
    """``(i, j, rk, sim)``: the ``k`` rows most similar to each row of ``m`` (columns with
    ``axis='cols'``) among those that share a column with it. Exact; see the module."""
    if k < 1:
        raise ValueError("k must be at least 1")
    e = weighted_entries(_orient(m, axis), share, floor)
    least = floors(e, k, share, floor)
    scored = exact(candidates(e, least, share, floor), e).join(least, "i")
    return top_k_per_row(scored.where(F.col("value") >= F.col("least") - F.lit(SLACK)), k)
