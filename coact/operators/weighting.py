"""Log-entropy weighting of the item x user frequency matrix.

``gf_i = sum_j |tf_ij|``, ``p_ij = tf_ij / gf_i``,
``w_i = 1 + sign * sum_j(-|p_ij| ln|p_ij| / ln n_users)`` and
``a_ij = ln(1 + |tf_ij|) * w_i``.  The reference adds the entropy term
(``sign=+1``, favouring spread-out items); the textbook weight subtracts it
(``sign=-1``).  ``n_users`` defaults to the implied column count, max(j) + 1.
Every step is one grouped aggregate or a join on the row index (items: a
bounded dimension, so the per-row vectors are broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coact.functions.scalar import entropy_term, log1p_abs, signed_log1p
from coact.operators import matrix as mx
from coact.operators.activity import bounded_broadcast


def global_frequency(tf: DataFrame) -> DataFrame:
    """``gf_i = sum_j |tf_ij|`` as a vector ``(i, value)``."""
    return mx.row_abs_sum(tf)


def relative_frequency(tf: DataFrame, row_bound: int | None = None) -> DataFrame:
    """``p_ij = tf_ij / gf_i`` (gf > 0 for every stored row)."""
    gf = global_frequency(tf)
    return mx.row_divide(tf, bounded_broadcast(gf, row_bound) if row_bound else gf)


def n_columns(tf: DataFrame) -> Column:
    """The implied column count ``max(j) + 1`` as a scalar subquery."""
    return tf.agg((F.max("j") + 1).cast("double").alias("n")).scalar()


def entropy_weight(tf: DataFrame, n_users: Column | float | None = None, sign: int = 1,
                   row_bound: int | None = None) -> DataFrame:
    """``w_i = 1 + sign * sum_j(-|p| ln|p| / ln n_users)`` as a vector ``(i, value)``."""
    n = n_columns(tf) if n_users is None else n_users
    p = relative_frequency(tf, row_bound)
    h = p.groupBy("i").agg(F.sum(entropy_term(F.col("value"), n)).alias("h"))
    return h.select("i", (F.lit(1.0) + F.lit(float(sign)) * F.col("h")).alias("value"))


def log_frequency(tf: DataFrame) -> DataFrame:
    return mx.map_values(tf, log1p_abs)


def signed_log_frequency(tf: DataFrame) -> DataFrame:
    return mx.map_values(tf, signed_log1p)


def log_entropy(tf: DataFrame, n_users: Column | float | None = None, sign: int = 1,
                row_bound: int | None = None) -> DataFrame:
    """``a_ij = ln(1 + |tf_ij|) * w_i``."""
    w = entropy_weight(tf, n_users, sign, row_bound)
    return mx.row_scale(log_frequency(tf), bounded_broadcast(w, row_bound) if row_bound else w)
