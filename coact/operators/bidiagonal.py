"""The leading singular triple of a sparse matrix by Golub-Kahan bidiagonalisation.

From a start vector the recurrences ``A v_k = alpha_k u_k + beta_(k-1) u_(k-1)`` and
``A^T u_k = alpha_k v_k + beta_k v_(k+1)`` build two orthonormal bases; every new
vector is made orthogonal to all earlier ones of its side. The driver holds only
``alpha`` and ``beta`` (two numbers a step) and decomposes that small matrix; both
bases stay tables in the shared folder, so a lost executor reads files again.

A product is one join and one sum. A vector carries the number of matrix entries
of each of its ids, which its own sum counts along the way, so popular ids are
joined apart (:func:`coact.operators.skew.join_groups`).

Defined results: duplicate coordinates are summed, null and zero entries take no
part; an empty or zero matrix has sigma 0 and empty vectors; of equal leading
values one pair of vectors is returned; the largest component of ``u`` is positive
(of equal ones that of the smallest id). Not reaching the tolerance is an error.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coact.operators.skew import join_groups
from coact.session import scratch_dir

NEGLIGIBLE = 1e-13       # of the largest coefficient: the bases span an invariant subspace


class Triple(NamedTuple):
    sigma: float
    u: DataFrame         # i, value
    v: DataFrame         # j, value
    steps: int


def _staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path), path


class _Basis:
    """Vectors ``(id, x, n)`` of one side in files, not scaled; ``norms`` scales them."""

    def __init__(self, key: str):
        self.key, self.paths, self.norms = key, [], []

    def _read(self, spark) -> DataFrame:
        return spark.read.parquet(*self.paths)

    def _sum(self, spark, factors: list[float]) -> DataFrame:
        """``(id, y)``: the stored vectors times ``factors``, added up."""
        by_step = F.element_at(F.array(*map(F.lit, factors)), F.col("step") + 1)
        return self._read(spark).groupBy(self.key).agg(F.sum(F.col("x") * by_step).alias("y"))

    def add(self, raw: DataFrame) -> float:
        """Store what of ``raw`` is orthogonal to the basis; its length."""
        spark, key, step = raw.sparkSession, self.key, len(self.paths)
        if self.paths:
            raw, _ = _staged(raw, "bidiagonal-raw")
            dots = (self._read(spark).select(key, "step", F.col("x").alias("b")).join(raw, key)
                    .groupBy("step").agg(F.sum(F.col("x") * F.col("b")).alias("dot")).collect())
            factors = [0.0] * step
            for r in dots:                              # one number for each earlier step
                factors[r["step"]] = r["dot"] / self.norms[r["step"]] ** 2 if self.norms[r["step"]] else 0.0
            raw = (raw.join(self._sum(spark, factors), key, "left")
                   .select(key, (F.col("x") - F.coalesce("y", F.lit(0.0))).alias("x"), "n"))
        kept, path = _staged(raw.select(key, "x", "n", F.lit(step).alias("step")), "bidiagonal")
        self.paths.append(path)
        self.norms.append(float(kept.agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("s")).first()["s"] or 0.0))
        return self.norms[-1]

    def last(self, spark) -> DataFrame:
        return spark.read.parquet(self.paths[-1]).select(
            self.key, (F.col("x") / F.lit(self.norms[-1] or 1.0)).alias("x"), "n")

    def combined(self, spark, weights: np.ndarray) -> DataFrame:
        factors = [float(w) / n if n else 0.0 for w, n in zip(weights, self.norms)]
        return self._sum(spark, factors).withColumnRenamed("y", "value")


def _times(entries: DataFrame, vector: DataFrame, on: str, out: str, total: int) -> DataFrame:
    return (join_groups(entries, vector, [on], "n", total).groupBy(out)
            .agg(F.sum(F.col("value") * F.col("x")).alias("x"), F.count("*").alias("n")))


def leading_triple(a: DataFrame, tol: float = 1e-10, max_steps: int = 100) -> Triple:
    """Largest singular value of ``a`` (``i, j, value``) with both unit vectors.

    Ends when the residual ``|A^T u - sigma v|`` is at most ``tol * sigma``."""
    spark = a.sparkSession
    entries, _ = _staged(a.groupBy("i", "j").agg(F.sum("value").alias("value")).where(F.col("value") != 0),
                         "bidiagonal-entries")
    total = entries.count()
    if not total:
        none = entries.limit(0)
        return Triple(0.0, none.select("i", "value"), none.select("j", "value"), 0)
    left, right = _Basis("i"), _Basis("j")
    # all components differ, so that the start is not orthogonal to the leading vector but by accident
    start = 1 + F.pmod(F.xxhash64("j"), F.lit(1009)) / F.lit(1009.0)
    right.add(entries.groupBy("j").agg(F.count("*").alias("n")).select("j", start.alias("x"), "n"))
    alpha, beta = [], []
    for step in range(1, max_steps + 1):
        alpha.append(left.add(_times(entries, right.last(spark), "j", "i", total)))
        beta.append(right.add(_times(entries, left.last(spark), "i", "j", total)))
        p, s, qt = np.linalg.svd(np.diag(alpha) + np.diag(beta[:-1], 1))
        spans = min(alpha[-1], beta[-1]) <= NEGLIGIBLE * max(alpha + beta)
        if spans or beta[-1] * abs(p[-1, 0]) <= tol * s[0]:
            break
    else:
        raise RuntimeError(f"no leading singular value within {tol:g} after {max_steps} steps")
    u = left.combined(spark, p[:, 0])
    top = u.orderBy(F.round(F.abs("value"), 12).desc(), "i").first()
    sign = F.lit(-1.0 if top["value"] < 0 else 1.0)
    v = right.combined(spark, np.append(qt[0], 0.0))
    return Triple(float(s[0]), u.select("i", (F.col("value") * sign).alias("value")),
                  v.select("j", (F.col("value") * sign).alias("value")), step)
