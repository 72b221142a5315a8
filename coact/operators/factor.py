"""Truncated SVD of the weighted item x user matrix and the latent-space operators.

Orientation: ``A`` is items x users.  ``A = U s V^T``; the item factors ``U``
(items x k) and ``s`` are all the later steps need, ``V`` (users) is never
formed.

One route to ``U, s`` for every size, :mod:`coact.operators.svd`.

Component signs are fixed (largest-magnitude entry positive) and order is
descending.  The latent representation is ``L = U * s**power`` with the
reference's ``power = 0.5`` (its ``S`` is the square root of the singular
values).  Everything downstream joins the small factor table or broadcasts
it into an Arrow ``mapInPandas`` block product.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coact.functions.scalar import safe_div
from coact.operators import matrix as mx
from coact.operators.similarity import SIM_DIGITS
from coact.operators.svd import PANEL_ROWS, block_svd
from coact.session import staged
from coact.sources.log import spread

LATENT_POWER = 0.5


class Factors:
    """Item factors of a truncated SVD: item index ``i`` of every factor row and
    ``k`` singular values, descending. The orthonormal columns ``u`` (items x k)
    are panels of rows ``(p, u)`` in files; they come to the driver only for an
    operator that broadcasts them (the band bounds the items, the rank the columns)."""

    def __init__(self, index: np.ndarray, u: np.ndarray | None, s: np.ndarray, panels: DataFrame | None = None):
        self.index, self._u, self.s, self.panels = index, u, s, panels

    @property
    def k(self) -> int:
        return len(self.s)

    @property
    def u(self) -> np.ndarray:
        if self._u is None:
            self._u = np.zeros((len(self.index), self.k))
            for r in self.panels.toLocalIterator() if self.panels is not None else ():
                at = r["p"] * PANEL_ROWS
                self._u[at:at + PANEL_ROWS] = np.frombuffer(r["u"]).reshape(-1, self.k)
        return self._u

    def latent(self, power: float = LATENT_POWER) -> np.ndarray:
        """``L = U * s**power`` (items x k)."""
        return self.u * np.power(self.s, power)[None, :]

    def energy(self) -> float:
        return float(np.sum(self.s ** 2))

    def rows(self, spark: SparkSession, power: float) -> DataFrame:
        """``(i, vector)`` with ``vector = U[i] * s**power``, made from the panels in tasks."""
        k, scale = self.k, np.power(self.s, power)
        index = spark.sparkContext.broadcast(self.index.astype("int64"))
        if self.panels is None:
            pdf = pd.DataFrame({"p": [0], "u": [np.ascontiguousarray(self.u).tobytes()]})
            panels, rows = spark.createDataFrame(pdf, "p long, u binary"), len(self.index)
        else:
            panels, rows = self.panels, PANEL_ROWS

        def run(batches):
            for b in batches:
                for p, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    x = np.frombuffer(u).reshape(-1, k) * scale if k else np.zeros((0, 0))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(index.value[p * rows:p * rows + len(x)]),
                         pa.array(list(x), pa.list_(pa.float64()))], ["i", "vector"])

        return panels.select("p", "u").mapInArrow(run, "i long, vector array<double>")


def truncated_svd(a: DataFrame, k: int | None) -> Factors:
    """``U, s`` of the items x users matrix ``a``, ``k=None``: of full rank
    (:mod:`coact.operators.svd`)."""
    index, panels, s = block_svd(a, k)
    return Factors(index, None, s, panels)


def energy(a: DataFrame) -> float:
    """Sum of the squared singular values, summed over the entries of ``a``."""
    return a.agg(F.sum(F.col("value") * F.col("value"))).first()[0] or 0.0


def factors_frame(spark: SparkSession, f: Factors, power: float = LATENT_POWER) -> DataFrame:
    """``(i, vector array<double>)`` with ``vector = L[i]``."""
    return f.rows(spark, power)


def factors_long(spark: SparkSession, f: Factors, scale_power: float = 0.0) -> DataFrame:
    """``(i, d, u)`` with ``u = U[i, d] * s[d]**scale_power`` — the join form of the factors."""
    return f.rows(spark, scale_power).select("i", F.posexplode("vector").alias("d", "u")).select(
        "i", F.col("d").cast("bigint").alias("d"), "u")


def singular_values_frame(spark: SparkSession, f: Factors) -> DataFrame:
    pdf = pd.DataFrame({"d": np.arange(f.k, dtype="int64"), "s": f.s})
    return spark.createDataFrame(pdf, "d long, s double")


def _chunk_rows(n_items: int, k: int = 1, budget: int = 1 << 22, made: int = 1 << 20) -> int:
    """Rows per block product so one ``rows x n_items`` score block stays near ``budget`` doubles
    (32 MB) and the ``k`` results of each row near ``made`` rows, whatever the Arrow batch size."""
    return max(1, min(budget // max(1, n_items), made // max(1, k)))


def _topk_order(key: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest finite keys, ties by id asc (exact: all ties at the
    k-th value are candidates before the final sort)."""
    finite = np.nonzero(np.isfinite(key))[0]
    if len(finite) > k:
        kth = np.partition(key[finite], len(finite) - k)[len(finite) - k]
        finite = finite[key[finite] >= kth]
    return finite[np.lexsort((ids[finite], -key[finite]))][:k]


# --- latent similarity, block product --------------------------------------------------------

def latent_similarity_topk(spark: SparkSession, f: Factors, k: int, normalize: bool = True,
                           power: float = LATENT_POWER, blocks: int | None = None) -> DataFrame:
    """``(i, j, rk, sim)``: the ``k`` most similar other items in the latent space.

    ``sim = L L^T`` (optionally divided by ``sqrt|diag|`` on both sides).  The
    factor matrix is broadcast once; each task multiplies its block of rows
    by ``L^T`` with BLAS (in chunks of bounded size) and keeps only k per row,
    so the items x items matrix is never materialised.  Ties: rounded
    similarity desc, then index asc.  Zero-norm items are left out.
    """
    lat = f.latent(power)
    norms = np.sqrt(np.abs(np.einsum("ij,ij->i", lat, lat)))
    keep = norms > 0
    lat, idx, norms = lat[keep], f.index[keep].astype("int64"), norms[keep]
    bc = spark.sparkContext.broadcast((lat, idx, norms))
    n = len(idx)
    nb = blocks or max(1, min(n, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def top_of(rows: np.ndarray, lat_, idx_, norms_) -> pd.DataFrame:
        sims = lat_[rows] @ lat_.T
        if normalize:
            sims = sims / norms_[rows][:, None] / norms_[None, :]
        out_i, out_j, out_rk, out_s = [], [], [], []
        for r, row in zip(rows, sims):
            row[r] = -np.inf                      # never the item itself
            order = _topk_order(np.round(row, SIM_DIGITS), idx_, k)
            out_i.append(np.full(len(order), idx_[r]))
            out_j.append(idx_[order])
            out_rk.append(np.arange(1, len(order) + 1))
            out_s.append(np.round(row[order], SIM_DIGITS))
        return pd.DataFrame({"i": np.concatenate(out_i), "j": np.concatenate(out_j),
                             "rk": np.concatenate(out_rk).astype("int64"),
                             "sim": np.concatenate(out_s)})

    def block_topk(batches):
        lat_, idx_, norms_ = bc.value
        step = _chunk_rows(len(idx_))
        for pdf in batches:
            positions = pdf["p"].to_numpy()
            for c0 in range(0, len(positions), step):
                rows = positions[c0:c0 + step]
                if len(rows):
                    yield top_of(rows, lat_, idx_, norms_)

    positions = spark.range(n).withColumnRenamed("id", "p").repartition(nb)
    return positions.mapInPandas(block_topk, "i long, j long, rk long, sim double")


def fold_in(a_cols: DataFrame, factor_rows: DataFrame) -> DataFrame:
    """Project new rows into the latent space: ``x . U * s**-power``.

    ``a_cols``: ``(row, i, value)`` entries of the new rows over the item
    index; ``factor_rows``: ``(i, d, u)`` with the scaling already applied.
    A join on the item index (factors are items x k: broadcast) and a grouped
    sum per (row, d).
    """
    return (a_cols.join(F.broadcast(factor_rows), "i")
                  .groupBy("row", "d").agg(F.sum(F.col("value") * F.col("u")).alias("value")))


def fold_in_vectors(spark: SparkSession, a_cols: DataFrame, f: Factors, scale_power: float) -> DataFrame:
    """:func:`fold_in` as ``(row, vector)``: the entries of a row meet the broadcast
    factors in one Arrow task, so that no row per (entry, d) is made."""
    bc = spark.sparkContext.broadcast((f.index, f.u * np.power(f.s, scale_power)[None, :]))

    def run(batches):
        index, mat = bc.value
        for pdf in batches:
            yield pd.DataFrame({"row": pdf["i"], "vector": [
                (v @ mat[np.searchsorted(index, i)]).tolist() for i, v in zip(pdf["indices"], pdf["values"])]})

    packed = mx.rows_packed(a_cols.select(F.col("row").alias("i"), F.col("i").alias("j"), "value"))
    return packed.mapInPandas(run, f"row {dict(a_cols.dtypes)['row']}, vector array<double>")


def vectors_from_long(long: DataFrame, key: str) -> DataFrame:
    """``(key, d, value)`` -> ``(key, vector)`` ordered by d (k entries per key)."""
    return long.groupBy(key).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("d", "value"))), lambda s: s["value"]).alias("vector"))


def array_cosine(a, b):
    """Cosine of two array<double> columns with higher-order functions (JVM-side)."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))
    nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda acc, x: acc + x * x))
    return dot / (na * nb)


def rank_by_cosine(df: DataFrame, key: str, array_col: str, query_key) -> DataFrame:
    """Cosine of every dense vector to the vector of row ``query_key``, descending.

    The arrays are exploded by position and equi-joined with the (broadcast,
    one-vector) query on the position — a linear pass, no pairwise product.
    """
    el = df.select(key, F.posexplode(array_col).alias("pos", "x")).withColumn("x", F.col("x").cast("double"))
    q = el.where(F.col(key) == query_key).select("pos", F.col("x").alias("q"))
    qn = q.agg(F.sqrt(F.sum(F.col("q") * F.col("q")))).scalar()
    per = el.join(F.broadcast(q), "pos", "left").groupBy(key).agg(
        F.sum(F.col("x") * F.coalesce("q", F.lit(0.0))).alias("dot"),
        F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("n"))
    sim = F.round(safe_div(F.col("dot"), F.col("n") * qn), 6).alias("sim")     # zero vectors have none
    return per.select(key, sim).where(F.col("sim").isNotNull()).orderBy(F.desc("sim"), key)


def score_topk(spark: SparkSession, queries: DataFrame, f: Factors, k: int, scale_power: float,
               mode: str = "dot") -> DataFrame:
    """For every query vector ``(row, vector)`` the ``k`` best items, ``(row, rk, i, score)``.

    ``mode='dot'``: ``score = q . (U * s**scale_power)[i]``; ``mode='cosine'``:
    cosine between ``q`` and the latent rows ``L[i]``.  Arrow batches, BLAS in
    chunks of bounded size, top-k per row inside the task; the factors are
    broadcast once.
    """
    if mode == "dot":
        mat = f.u * np.power(f.s, scale_power)[None, :]
    else:
        mat = f.latent(LATENT_POWER)
    bc = spark.sparkContext.broadcast((mat, f.index.astype("int64")))

    def top_of(pdf: pd.DataFrame, mat_, idx_, mnorm) -> pd.DataFrame:
        q = np.vstack(pdf["vector"].to_numpy())
        sc = q @ mat_.T
        if mode == "cosine":
            qn = np.sqrt(np.einsum("ij,ij->i", q, q))
            with np.errstate(divide="ignore", invalid="ignore"):
                sc = sc / qn[:, None] / mnorm[None, :]
        rows, rks, items, scores = [], [], [], []
        sc = np.round(sc, SIM_DIGITS)
        ask = pdf["row"].to_numpy()
        if k >= len(idx_) and np.isfinite(sc).all():        # all items: sorted in one go, the index is ascending
            order = np.argsort(-sc, axis=1, kind="stable")
            return pd.DataFrame({"row": np.repeat(ask, len(idx_)),
                                 "rk": np.tile(np.arange(1, len(idx_) + 1, dtype="int64"), len(ask)),
                                 "i": idx_[order].ravel(), "score": np.take_along_axis(sc, order, axis=1).ravel()})
        for r, row in zip(ask, sc):
            order = _topk_order(row, idx_, k)
            rows.append(np.full(len(order), r))
            rks.append(np.arange(1, len(order) + 1))
            items.append(idx_[order])
            scores.append(row[order])
        return pd.DataFrame({"row": np.concatenate(rows), "rk": np.concatenate(rks).astype("int64"),
                             "i": np.concatenate(items), "score": np.concatenate(scores)})

    def run(batches):
        mat_, idx_ = bc.value
        mnorm = np.sqrt(np.einsum("ij,ij->i", mat_, mat_))
        step = _chunk_rows(len(idx_), min(k, len(idx_)))
        for whole in batches:
            for c0 in range(0, len(whole), step):
                part = whole.iloc[c0:c0 + step]
                if len(part):
                    yield top_of(part, mat_, idx_, mnorm)

    q = queries.select(F.col("row"), F.col("vector"))
    return q.mapInPandas(run, f"row {dict(queries.dtypes)['row']}, rk long, i long, score double")


# --- power iteration ----------------------------------------------------------------------------

POWER_ROWS_PER_TASK = 1_000_000      # entries that a task packs


def _power_pass(rows: DataFrame, index: np.ndarray, u: np.ndarray, before: np.ndarray | float) -> tuple:
    """One pass over the packed columns ``a_j`` of a matrix: ``A w`` with ``w_j = a_j . u``, ``|w|`` and
    ``v . w``, where ``v_j = a_j . before``, or ``before`` itself if it is a number."""
    bc = rows.sparkSession.sparkContext.broadcast((index, u, before))

    def run(batches):
        index_, u_, before_ = bc.value
        total, squares, dot = np.zeros(len(index_)), 0.0, 0.0
        for b in batches:
            if not b.num_rows:
                continue
            items, values = b.column(0), b.column(1)
            ends = np.cumsum(np.diff(items.offsets.to_numpy()))
            starts = np.r_[0, ends[:-1]]                            # no column is empty
            at = np.searchsorted(index_, items.flatten().to_numpy())
            x = values.flatten().to_numpy()
            w = np.add.reduceat(x * u_[at], starts)
            v = np.add.reduceat(x * before_[at], starts) if isinstance(before_, np.ndarray) else before_
            squares += float(w @ w)
            dot += float(np.sum(v * w))
            total += np.bincount(at, weights=x * np.repeat(w, ends - starts), minlength=len(index_))
        own = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[own, -1, -2], pa.int64()), pa.array(np.r_[total[own], squares, dot])], ["p", "x"])

    out, ends = np.zeros(len(index)), [0.0, 0.0]
    # a number for each row of the matrix
    for r in rows.mapInArrow(run, "p long, x double").groupBy("p").agg(F.sum("x").alias("x")).toLocalIterator():
        if r["p"] >= 0:
            out[r["p"]] = r["x"]
        else:
            ends[-1 - r["p"]] = r["x"]
    bc.unpersist()
    return out, float(np.sqrt(ends[0])), ends[1]


def leading_singular_value(a: DataFrame, epsilon: float = 1e-10, max_iter: int = 200) -> DataFrame:
    """Power iteration for the leading right singular vector of ``a``.

    Iterates ``v <- A^T (A v) / |A^T A v|`` until ``|v . v'| > 1 - epsilon``, from equal
    components.  ``v`` (one entry per column, unbounded) is never stored: it is ``A^T u`` for a
    vector ``u`` over the rows (items, bounded by the band), so one pass over the packed columns
    makes a component of ``v`` and of the next ``v`` where the column is, and sums the next
    ``u``.  The columns (user rows, bounded by the band) are packed into files once; a step
    shuffles and brings to the driver a number per row.  Returns one row
    ``iterations, sigma, converged`` (not converged: a zero or empty matrix); reaching
    ``max_iter`` is an error.
    """
    spark = a.sparkSession
    a = a.where(F.col("i").isNotNull() & F.col("j").isNotNull() & F.col("value").isNotNull())
    size = a.agg((F.max("j") + 1).alias("columns"), F.count("*").alias("n")).first()
    tasks = -(-size["n"] // POWER_ROWS_PER_TASK)
    columns = spread(mx.transpose(a), tasks if tasks > spark.sparkContext.defaultParallelism else None, "i")
    rows = staged(mx.rows_packed(columns).select("indices", "values"), "power-columns")
    sums = sorted((r["i"], r["value"]) for r in a.groupBy("i").agg(F.sum("value").alias("value")).toLocalIterator())
    index = np.array([i for i, _ in sums], dtype="int64")
    before = 1.0 / float(np.sqrt(size["columns"] or 1))             # every component of the first v
    u = before * np.array([x for _, x in sums], dtype="float64")    # A v
    sigma, converged = 0.0, False
    for it in range(1, max_iter + 1):
        following, norm, dot = _power_pass(rows, index, u, before)
        if norm == 0.0:
            break
        sigma = float(np.sqrt(norm))
        if abs(dot) / norm > 1 - epsilon:
            converged = True
            break
        before, u = u / norm, following / norm
    else:
        raise RuntimeError(f"power iteration: not within {epsilon:g} after {max_iter} steps")
    return spark.createDataFrame([(it, sigma, converged)], "iterations long, sigma double, converged boolean")
