"""Cosine similarity between the rows (or columns) of a sparse matrix, top-k.

``A . A^T`` is a self-join on the shared index followed by a grouped sum.  Only
pairs ``a < b`` are produced (the product is symmetric) and mirrored after the
aggregation, halving the pair explosion.  The number of pairs a shared index
contributes is (entries in that column)^2; for the item x user matrix that is
bounded by the activity band's ``max_items``.  For user x user similarity the
shared column is an item, whose audience is unbounded: :func:`pair_dots`
then splits hot columns into salted blocks (``block``).  Row norms are one row per matrix row; they are
broadcast only when that count is bounded by a parameter (``row_bound``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coact.operators import matrix as mx
from coact.operators.activity import bounded_broadcast
from coact.operators.skew import join_many

SIM_DIGITS = 9  # similarities are compared and ranked after rounding to 9 places


def _orient(m: DataFrame, axis: str) -> DataFrame:
    if axis == "rows":
        return m
    if axis == "cols":
        return mx.transpose(m)
    raise ValueError(f"axis must be 'rows' or 'cols', not {axis!r}")


def pair_dots(m: DataFrame, axis: str = "rows", block: int | None = None,
              key_bound: int | None = None) -> DataFrame:
    """``(a, b, dot)`` for every pair ``a < b`` of rows sharing a column.

    Without ``block`` the self-join is a plain equi-join on the shared column
    (right when every column holds few entries, e.g. the items of one user
    under the activity band).  With ``block`` a column with ``n`` entries is
    split into ``s = ceil(n / block)`` buckets by a hash of the row id; each
    entry is copied once per bucket on either side (as row bucket / as column
    bucket) and the join runs on ``(column, b1, b2)``.  Every pair meets in
    exactly one task and no task sees more than about ``block^2`` pairs, so a
    hot column (one item with a third of all users) is spread over ``s^2``
    tasks instead of one.  ``key_bound`` bounds the number of distinct columns
    (the per-column counts are then broadcast).
    """
    m = _orient(m, axis)
    if block is None:
        left = m.select(F.col("i").alias("a"), F.col("j").alias("k"), F.col("value").alias("va"))
        right = m.select(F.col("i").alias("b"), F.col("j").alias("k"), F.col("value").alias("vb"))
        return (left.join(right, "k").where(F.col("a") < F.col("b"))
                    .groupBy("a", "b").agg(F.sum(F.col("va") * F.col("vb")).alias("dot")))
    counts = m.groupBy(F.col("j").alias("k")).agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(float(block)))).cast("int").alias("s"))
    counts = bounded_broadcast(counts, key_bound) if key_bound is not None else counts
    e = (m.select(F.col("i").alias("r"), F.col("j").alias("k"), "value").join(counts, "k")
          .withColumn("own", F.pmod(F.xxhash64("r"), F.col("s")).cast("int"))
          .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("s") - 1))))
    left = e.select("k", F.col("own").alias("b1"), F.col("copy").alias("b2"),
                    F.col("r").alias("a"), F.col("value").alias("va"))
    right = e.select("k", F.col("copy").alias("b1"), F.col("own").alias("b2"),
                     F.col("r").alias("b"), F.col("value").alias("vb"))
    return (left.join(right, ["k", "b1", "b2"]).where(F.col("a") < F.col("b"))
                .groupBy("a", "b").agg(F.sum(F.col("va") * F.col("vb")).alias("dot")))


def gram(m: DataFrame, axis: str = "rows", epsilon: float = 0.0) -> DataFrame:
    """Full symmetric ``A A^T`` (axis='rows') or ``A^T A`` (axis='cols') in COO form,
    diagonal included, ``epsilon`` added to every stored product."""
    mo = _orient(m, axis)
    dots = pair_dots(mo)
    off = dots.select(F.col("a").alias("i"), F.col("b").alias("j"), "dot").unionByName(
        dots.select(F.col("b").alias("i"), F.col("a").alias("j"), "dot"))
    diag = mo.groupBy("i").agg(F.sum(F.col("value") * F.col("value")).alias("dot")).select(
        "i", F.col("i").alias("j"), "dot")
    return off.unionByName(diag).select("i", "j", (F.col("dot") + F.lit(float(epsilon))).alias("value"))


def cosine_similarity(m: DataFrame, axis: str = "rows", epsilon: float = 0.0,
                      include_diagonal: bool = False, row_bound: int | None = None,
                      block: int | None = None, key_bound: int | None = None) -> DataFrame:
    """Cosine similarity ``dot / |a| / |b|`` of every pair of rows that share a column.

    With ``epsilon`` every dot product (the diagonal too) gets ``+ epsilon``
    before the division, as in the dense reference formula; pairs with no
    overlap stay implicit.  ``row_bound`` is a proven bound on the number of
    rows (e.g. top N items) that allows broadcasting the norms.
    """
    mo = _orient(m, axis)
    eps = F.lit(float(epsilon))
    dots = pair_dots(mo, block=block, key_bound=key_bound)
    both = dots.select(F.col("a").alias("i"), F.col("b").alias("j"), "dot").unionByName(
        dots.select(F.col("b").alias("i"), F.col("a").alias("j"), "dot"))
    sq = mo.groupBy("i").agg(F.sum(F.col("value") * F.col("value")).alias("sq"))
    norms = sq.select("i", F.sqrt(F.col("sq") + eps).alias("ni"))
    if include_diagonal:
        both = both.unionByName(sq.select("i", F.col("i").alias("j"), F.col("sq").alias("dot")))
    nb = bounded_broadcast if row_bound is not None else (lambda df, _b: df)
    n_i = nb(norms, row_bound)
    n_j = nb(norms.select(F.col("i").alias("j"), F.col("ni").alias("nj")), row_bound)
    return (both.join(n_i, "i").join(n_j, "j")
                .select("i", "j", ((F.col("dot") + eps) / F.col("ni") / F.col("nj")).alias("value")))


def cosine_rows(m: DataFrame, requests: DataFrame, n: int, epsilon: float = 0.0) -> DataFrame:
    """``(dot + epsilon) / |a| / |b|`` of the requested rows with every row, as the dense formula has it.

    Rows without a common column have ``epsilon`` over the norms and are listed too: ``n`` cells
    (rows ``0 .. n - 1``) for each requested ``i``, laid out from the row range, not by a cross join.
    Only entries of requested rows meet others.  Rows without any entry have no norm and are left out,
    requested or not; a row is not paired with itself.
    """
    asked = requests.select("i").distinct()
    eps = F.lit(float(epsilon))
    mine = m.join(asked, "i", "left_semi")
    dots = join_many(mine.select("i", F.col("j").alias("k"), F.col("value").alias("va")),
                     m.select(F.col("i").alias("j"), F.col("j").alias("k"), F.col("value").alias("vb")), "k")
    dots = dots.groupBy("i", "j").agg(F.sum(F.col("va") * F.col("vb")).alias("dot"))
    norms = m.groupBy("i").agg(F.sqrt(F.sum(F.col("value") * F.col("value")) + eps).alias("ni"))
    norms = norms.where(F.col("ni") > 0)
    cells = asked.join(norms, "i").select("i", "ni", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))).alias("j"))
    other = norms.select(F.col("i").alias("j"), F.col("ni").alias("nj"))
    return (cells.where(F.col("i") != F.col("j")).join(other, "j").join(dots, ["i", "j"], "left")
                 .select("i", "j", ((F.coalesce("dot", F.lit(0.0)) + eps) / F.col("ni") / F.col("nj")).alias("value")))


def rank_order(value: Column, tie: Column) -> list[Column]:
    return [F.round(value, SIM_DIGITS).desc(), tie.asc()]


def top_k_per_row(sim: DataFrame, k: int, names: DataFrame | None = None,
                  name_bound: int | None = None, exclude_self: bool = True) -> DataFrame:
    """The ``k`` largest entries of every row, ranked by rounded value desc then name.

    With ``names`` (a dimension ``(i, item)``) the output is
    ``item, related, rk, sim``; without, ``i, j, rk, sim``.  The filter
    ``row_number <= k`` lets Spark insert a partial per-row limit before the
    shuffle (WindowGroupLimit), so each map task emits at most k rows per row id.
    """
    s = sim.where(F.col("i") != F.col("j")) if exclude_self else sim
    if names is not None:
        nb = bounded_broadcast if name_bound is not None else (lambda df, _b: df)
        ni = nb(names.select("i", F.col("item")), name_bound)
        nj = nb(names.select(F.col("i").alias("j"), F.col("item").alias("related")), name_bound)
        s = s.join(ni, "i").join(nj, "j").select("item", "related", F.col("value"))
        key, other = "item", "related"
    else:
        s = s.select("i", "j", "value")
        key, other = "i", "j"
    w = Window.partitionBy(key).orderBy(*rank_order(F.col("value"), F.col(other)))
    return (s.withColumn("rk", F.row_number().over(w).cast("bigint"))
             .where(F.col("rk") <= k)
             .select(key, other, "rk", F.round("value", SIM_DIGITS).alias("sim")))


def related_to_item(top_k: DataFrame, items: DataFrame) -> DataFrame:
    """Look up the related list of each requested item; unknown items give nothing."""
    return top_k.join(items.select("item").distinct(), "item", "left_semi")
