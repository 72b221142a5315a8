"""Rating prediction with hold-out evaluation on a ratings matrix ``R`` (users x items).

All predictors are written for *row entities* (users for ``kind='user'``);
``kind='item'`` is the same formula on ``R^T`` with the item similarity, then
transposed back.  Implicit zeros take part as in the dense reference formulas:

* bias-corrected: ``pred[u, j] = b[u] + (sum_v S[u,v] (r[v,j] - b[v])) / sum_v |S[u,v]|``
  expands to ``b[u] + ((S R)[u,j] - (S b)[u]) / A[u]`` — a sparse product and
  two per-row vectors, no dense matrix is materialised before the output;
* top-k: ``pred[u, j] = sum_{v in topk(u)} S[u,v] r[v,j] / sum_{v in topk(u)} |S[u,v]|``,
  where entities without a stored similarity count as similarity 0.

Outputs are dense over (rows present) x (0 .. n_cols - 1): one row per cell,
generated per row entity from a column range (bounded by the item count for
the user kind), never by a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coact.operators import matrix as mx
from coact.operators.similarity import SIM_DIGITS, cosine_similarity
from coact.session import staged

SPLIT_SEED = 42


def split_key(seed: int) -> Column:
    """A reproducible pseudo-random order for the entries of a row."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("i").cast("string"), F.col("j").cast("string")))


def train_test_split(r: DataFrame, n_test: int = 3, seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """Hold out ``n_test`` non-zero entries of every row, without replacement.

    A row with fewer entries gives all of them to the test side.  Train and
    test are disjoint by construction (one ranking, two complementary filters).
    The window is per row entity: bounded by the row's length.
    """
    w = Window.partitionBy("i").orderBy(split_key(seed), F.col("j"))
    ranked = r.where(F.col("value") != 0).withColumn("_rn", F.row_number().over(w))
    test = ranked.where(F.col("_rn") <= n_test).drop("_rn")
    train = ranked.where(F.col("_rn") > n_test).drop("_rn")
    return train, test


def n_cols(r: DataFrame) -> Column:
    return r.agg((F.max("j") + 1).cast("double").alias("n")).scalar()


def n_rows(r: DataFrame) -> Column:
    return r.agg((F.max("i") + 1).cast("double").alias("n")).scalar()


def row_means(r: DataFrame) -> DataFrame:
    """Mean of every stored row over the full column count (zeros included)."""
    return r.groupBy("i").agg((F.sum("value") / n_cols(r)).alias("value"))


def col_means(r: DataFrame) -> DataFrame:
    """Mean of every stored column over the full row count (zeros included)."""
    return r.groupBy("j").agg((F.sum("value") / n_rows(r)).alias("value")).withColumnRenamed("j", "i")


USER_PAIR_BLOCK = 2000


def similarity_for(r: DataFrame, kind: str, epsilon: float = 1e-9, item_bound: int | None = None) -> DataFrame:
    """Cosine similarity of users (rows) or items (columns), diagonal included.

    User pairs are found through shared items, whose audiences are unbounded,
    so the user kind uses the salted block self-join.
    """
    if kind == "user":
        return cosine_similarity(r, axis="rows", epsilon=epsilon, include_diagonal=True,
                                 block=USER_PAIR_BLOCK, key_bound=item_bound)
    return cosine_similarity(r, axis="cols", epsilon=epsilon, include_diagonal=True, row_bound=item_bound)


def _cells(rows: DataFrame, ncols: Column) -> DataFrame:
    """Every row of ``rows`` (one for each ``i``) at every column ``j = 0 .. ncols - 1``,
    generated in parallel chunks (an item row of the item kind spans all users).

    ``rows`` brings all that a cell needs of its row. Joined to the cells instead, adaptive
    execution would take the cells, whose size it guesses from the few chunks, for a small
    side and broadcast them through the driver.
    """
    return mx.expand_range(rows, ncols, "j")


def _bias_terms(r: DataFrame, s: DataFrame) -> DataFrame:
    """``(i, b, a, sb)``: mean, ``A[i] = sum |S[i, v]|`` and ``(S b)[i]`` of every row."""
    b = r.groupBy("i").agg((F.sum("value") / n_cols(r)).alias("b"))
    ab = (s.join(b.select(F.col("i").alias("j"), F.col("b").alias("bv")), "j", "left")
           .groupBy("i").agg(F.sum(F.abs("value")).alias("a"),
                             F.sum(F.col("value") * F.coalesce("bv", F.lit(0.0))).alias("sb")))
    return b.join(ab, "i")


def _bias_value(sr: str) -> Column:
    return F.col("b") + (F.coalesce(sr, F.lit(0.0)) - F.coalesce("sb", F.lit(0.0))) / F.col("a")


def _bias_rows(r: DataFrame, s: DataFrame) -> DataFrame:
    s = staged(s, "similarity")
    sr = mx.multiply(s, r).withColumnRenamed("value", "sr")
    terms = _bias_terms(r, s)
    return (_cells(terms, n_cols(r)).join(sr, ["i", "j"], "left")
            .select("i", "j", _bias_value("sr").alias("value")))


def predict_at(r: DataFrame, s: DataFrame, cells: DataFrame, kind: str = "user") -> DataFrame:
    """The bias-corrected prediction at the requested ``cells`` (i, j) of ``r`` only:
    the values of :func:`predict_bias_corrected` there, without the dense cells.

    The product is sampled where a cell meets the entries of one user: ratings
    (at most the band's items) for the item kind, similarities for the user kind.
    """
    o, want = _oriented(r, kind), _oriented(cells.select("i", "j", F.lit(0.0).alias("value")), kind)
    s = staged(s, "similarity")
    shape = o.agg((F.max("j") + 1).alias("n")).scalar()
    want = want.select("i", "j").distinct().where(F.col("j") < shape)
    if kind == "item":      # columns of R^T are users
        sr = mx.multiply_at(s, o, want)
    else:                   # (S R)[u, j] = (R^T S^T)[j, u]: the user is the column
        sr = mx.transpose(mx.multiply_at(mx.transpose(o), mx.transpose(s), mx.transpose(
            want.withColumn("value", F.lit(0.0)))))
    out = (want.join(_bias_terms(o, s), "i").join(sr.withColumnRenamed("value", "sr"), ["i", "j"], "left")
           .select("i", "j", _bias_value("sr").alias("value")))
    return out if kind == "user" else mx.transpose(out)


def _nearest(r: DataFrame, s: DataFrame, k: int) -> DataFrame:
    """The stored pairs of ``s`` that are among the ``k`` nearest of their row.

    Entities that share nothing with the row have no stored pair; their
    similarity is (about) 0, so they rank before negative ones and take places
    of the ``k``, though they add nothing to a prediction.
    """
    rounded = F.round("value", SIM_DIGITS)
    w = Window.partitionBy("i").orderBy(rounded.desc(), F.col("j").asc())
    absent = s.groupBy("i").agg((n_rows(r) - F.count("value")).alias("_absent"))
    shift = F.when(rounded < 0, F.col("_absent")).otherwise(F.lit(0.0))
    return (s.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k)
             .join(absent, "i").where(F.col("_rk") + shift <= k).drop("_rk", "_absent"))


def _topk_rows(r: DataFrame, s: DataFrame, k: int) -> DataFrame:
    nb = staged(_nearest(r, staged(s, "similarity"), k), "nearest")
    num = mx.multiply(nb, r).withColumnRenamed("value", "num")
    den = nb.groupBy("i").agg(F.sum(F.abs("value")).alias("den"))
    rows = r.select("i").distinct().join(den, "i")
    return (_cells(rows, n_cols(r)).join(num, ["i", "j"], "left")
            .select("i", "j", (F.coalesce("num", F.lit(0.0)) / F.col("den")).alias("value")))


def _oriented(r: DataFrame, kind: str) -> DataFrame:
    if kind not in ("user", "item"):
        raise ValueError(f"kind must be 'user' or 'item', not {kind!r}")
    return r if kind == "user" else mx.transpose(r)


def predict_bias_corrected(r: DataFrame, s: DataFrame, kind: str = "user") -> DataFrame:
    """Mean-centred neighbourhood prediction from all neighbours (dense output)."""
    pred = _bias_rows(_oriented(r, kind), s)
    return pred if kind == "user" else mx.transpose(pred)


def predict_topk(r: DataFrame, s: DataFrame, kind: str = "user", k: int = 40) -> DataFrame:
    """Prediction from the ``k`` most similar neighbours (self included), dense output."""
    pred = _topk_rows(_oriented(r, kind), s, k)
    return pred if kind == "user" else mx.transpose(pred)


def mse(pred: DataFrame, actual: DataFrame) -> DataFrame:
    """Mean squared error over the cells where the truth is non-zero."""
    a = actual.where(F.col("value") != 0).select("i", "j", F.col("value").alias("a"))
    p = pred.select("i", "j", F.col("value").alias("p"))
    d = F.col("p") - F.col("a")
    return a.join(p, ["i", "j"]).agg(F.avg(d * d).alias("mse"))
