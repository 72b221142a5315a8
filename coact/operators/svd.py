"""Truncated SVD of a distributed sparse matrix by filtered subspace iteration on ``A A^T``.

The driver holds thin blocks (items x block width: the basis ``V``, its products
``W = A A^T V`` and the blocks of a filter) and matrices of the basis's columns squared.
All that meets ``A`` runs in tasks:

* *Product.* ``A A^T`` is summed once from the packed user rows, as strips of its rows in
  files, if it has at most ``GRAM_RATIO`` cells for an entry of ``A``: a task multiplies its
  strips by the broadcast block, nothing is shuffled, and the number of users no longer
  matters. If there are more cells, ``A A^T`` is not formed: a task sums ``x (x^T Q)`` over
  its user rows, and the sums meet by panel of items.
* *Tall-skinny QR.* Every panel of ``PANEL_ROWS`` items is factored on its own; the small
  triangular factors are stacked and factored again, and directions that are numerically
  zero are dropped.

One step:

1. *Filter.* A Chebyshev polynomial of ``A A^T``, small on [0, smallest Ritz value]
   and growing above it, is applied to the Ritz vectors that have not converged. The
   products of a filter need no orthogonalisation between them; converged vectors,
   *locked*, are taken out after each. Its degree is what the worst residual needs, as
   far as the largest value grows by ``GROWTH`` at most.
2. *Tall-skinny QR* of the block, without its part in the locked vectors.
3. *Rayleigh-Ritz.* The iteration ends when the residuals of the first k are below
   ``TOLERANCE`` of the largest eigenvalue.

With few items (``BASIS_COLUMNS``) the unit vectors are the basis: it spans everything, and its
projected matrix is ``A A^T``.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coact.operators import matrix as mx
from coact.session import scratch_dir

OVERSAMPLE = 10
MIN_WIDTH = 128             # columns of a block, at least (as far as there are items)
BLOCK_CELLS = 1 << 24       # of a block that is wider than the rank needs
BASIS_COLUMNS = 3072        # so many items make one block that spans everything
GROWTH = 1e8                # of the largest value in one filter
MAX_DEGREE = 40
SAFETY = 30.0               # of the degree: the residuals are to fall so far below the limit
TOLERANCE = 1e-10
MAX_PRODUCTS = 500
PANEL_ROWS = 2048
GRAM_RATIO = 32             # cells of A A^T for an entry of A: dense strips cost less than user rows
STRIP_CELLS = 1 << 22       # of a strip of A A^T, which is a binary value (32 MB)
DEALT_ROWS = 50_000         # copies of user rows that are made at once
PAIRS = 1 << 20             # products of entries that are summed at once


def _slots(spark: SparkSession, count: int) -> np.ndarray:
    """Long keys that a shuffle into ``count`` partitions deals to one partition each."""
    ids = spark.range(count * 40).groupBy(F.expr(f"pmod(hash(id), {count})").alias("slot")).agg(F.min("id").alias("id"))
    return np.array(sorted(r["id"] for r in ids.collect()))[:count]


def gram_strips(a: DataFrame, index: np.ndarray) -> DataFrame:
    """``(p, g)``: strips of rows of ``A A^T``, dense, ``rows * p`` the first row. The user rows (bounded
    by the activity band) are dealt to the strips that they touch and summed there; not staged."""
    spark, n = a.sparkSession, len(index)
    cores = spark.sparkContext.defaultParallelism
    rows = -(-n // (cores * -(-n * n // (STRIP_CELLS * cores))))
    count = -(-n // rows)
    shared = spark.sparkContext.broadcast((index, _slots(spark, count)))

    def flat(items, values):
        lengths = np.diff(items.offsets.to_numpy()).astype(np.int64)
        return lengths, items.flatten().to_numpy(), values.flatten().to_numpy()

    def dealt(batches):
        index_, slots = shared.value
        for whole in batches:
            longest = int(np.diff(whole.column(0).offsets.to_numpy()).max(initial=1))
            step = max(1, DEALT_ROWS // min(count, longest))
            for b in (whole.slice(s, step) for s in range(0, whole.num_rows, step)):
                lengths, items, x = flat(b.column(0), b.column(1))
                at = np.searchsorted(index_, items)
                touched = np.unique(np.repeat(np.arange(len(lengths)), lengths) * count + at // rows)
                ends = pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32))
                user, p = pa.array(touched // count), touched % count
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots[p]), pa.array(p),
                     pa.ListArray.from_arrays(ends, pa.array(at.astype(np.int32))).take(user),
                     pa.ListArray.from_arrays(ends, pa.array(x)).take(user)], ["slot", "p", "at", "x"])

    def summed(batches):
        strips: dict[int, np.ndarray] = {}
        for b in batches:
            lengths, at, x = flat(b.column(2), b.column(3))
            at = at.astype(np.int64)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            strip, first = b.column(1).to_numpy()[owner], (np.cumsum(lengths) - lengths)[owner]
            for p in np.unique(strip):
                total = strips.setdefault(int(p), np.zeros(min(rows, n - int(p) * rows) * n))
                own = np.flatnonzero((strip == p) & (at // rows == p))      # its rows meet all of the user's items
                pairs = np.cumsum(lengths[owner[own]])
                for part in np.split(own, np.searchsorted(pairs, np.arange(PAIRS, pairs[-1], PAIRS)) if len(own) else []):
                    d = lengths[owner[part]]
                    one = np.repeat(part, d)
                    other = np.arange(len(one)) - np.repeat(np.cumsum(d) - d - first[part], d)
                    np.add.at(total, (at[one] - p * rows) * n + at[other], x[one] * x[other])
        for p, total in strips.items():
            yield pa.RecordBatch.from_pydict({"p": [p], "g": [total.tobytes()]})

    packed = mx.rows_packed(mx.transpose(a)).select("indices", "values")
    return (packed.mapInArrow(dealt, "slot long, p long, at array<int>, x array<double>")
                  .repartition(count, "slot").mapInArrow(summed, "p long, g binary"))


class Subspace:
    """Basis ``v``, its products ``w`` and the projected matrix ``t = v^T w``."""

    def __init__(self, a: DataFrame, index: np.ndarray):
        self.spark, self.index, self.n = a.sparkSession, index, len(index)
        self.path = scratch_dir(self.spark, "svd")
        self.count = -(-self.n // PANEL_ROWS)
        self.formed = self.n <= BASIS_COLUMNS or self.n * self.n <= GRAM_RATIO * a.count()
        if self.formed:
            gram_strips(a, index).write.parquet(f"{self.path}/gram")
            # what doesn't fit in memory is read from the files again
            self.stored = self.spark.read.parquet(f"{self.path}/gram").persist(StorageLevel.MEMORY_ONLY)
        else:                                       # user rows: bounded by the activity band
            mx.rows_packed(mx.transpose(a)).select("indices", "values").write.parquet(f"{self.path}/rows")
            self.stored = self.spark.read.parquet(f"{self.path}/rows").coalesce(
                self.spark.sparkContext.defaultParallelism)
        self.v = self.w = np.zeros((self.n, 0))
        self.t = np.zeros((0, 0))

    @property
    def columns(self) -> int:
        return self.v.shape[1]

    # --- in tasks

    def _panels(self, fn, schema: str) -> DataFrame:
        """``fn(p)``, a dictionary of columns, of every panel of items."""
        def run(batches):
            for b in batches:
                for p in b.column(0).to_pylist():
                    yield pa.RecordBatch.from_pydict({
                        k: [np.ascontiguousarray(x).tobytes() if isinstance(x, np.ndarray) else x]
                        for k, x in fn(p).items()})

        return self.spark.range(0, self.count, 1, self.count).mapInArrow(run, schema)

    def _gathered(self, parts: DataFrame, width: int) -> np.ndarray:
        """The thin block whose parts are ``(p, block)``, all of as many rows but the last."""
        got = parts.toArrow()
        out, order = np.zeros((self.n, width)), np.argsort(got.column("p").to_numpy())
        blocks = [b for chunk in got.column("block").chunks for b in chunk]
        at = [np.frombuffer(b.as_buffer()).reshape(-1, width) for b in blocks]
        rows = max((len(x) for x in at), default=0)
        for k in order:
            p = got.column("p")[int(k)].as_py()
            out[p * rows:(p + 1) * rows] = at[k]
        return out

    def spanned(self) -> tuple[np.ndarray, np.ndarray]:
        """All eigenvalues and vectors of ``A A^T`` of few items: the unit vectors are the basis."""
        lam, u = np.linalg.eigh(self._gathered(self.stored.select("p", F.col("g").alias("block")), self.n))
        return lam[::-1], u[:, ::-1]

    def product(self, q: np.ndarray) -> np.ndarray:
        """``A A^T q``."""
        shared = self.spark.sparkContext.broadcast(q if self.formed else (self.index, q))
        out = self._gathered((self._strips if self.formed else self._rows)(shared), q.shape[1])
        shared.unpersist()
        return out

    def _strips(self, shared: Broadcast) -> DataFrame:
        n = self.n

        def run(batches):
            for b in batches:
                for p, g in zip(b.column(0).to_pylist(), b.column(1)):
                    strip = np.frombuffer(g.as_buffer()).reshape(-1, n)
                    yield pa.RecordBatch.from_pydict({"p": [p], "block": [(strip @ shared.value).tobytes()]})

        return self.stored.select("p", "g").mapInArrow(run, "p long, block binary")

    def _rows(self, shared: Broadcast) -> DataFrame:
        count = self.count

        def partial(batches):
            index, q_ = shared.value
            total = np.zeros_like(q_)
            for b in batches:
                for items, values in zip(b.column(0), b.column(1)):
                    at = np.searchsorted(index, items.values.to_numpy())
                    x = values.values.to_numpy()
                    total[at] += np.outer(x, x @ q_[at])
            for p in range(count):
                part = total[p * PANEL_ROWS:(p + 1) * PANEL_ROWS]
                yield pa.RecordBatch.from_pydict({"p": [p], "block": [part.tobytes()]})

        def summed(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_py()) for x in table.column("block"))
            return pa.table({"p": table.column("p")[:1], "block": [total.tobytes()]})

        return self.stored.mapInArrow(partial, "p long, block binary").groupBy("p").applyInArrow(
            summed, "p long, block binary")

    def triangle(self, y: np.ndarray) -> np.ndarray:
        """The triangular factor of a thin block, from those of its panels."""
        shared = self.spark.sparkContext.broadcast(y)
        parts = self._panels(lambda p: {
            "p": p, "r": np.linalg.qr(shared.value[p * PANEL_ROWS:(p + 1) * PANEL_ROWS], mode="r")}, "p long, r binary")
        factors = sorted((r["p"], r["r"]) for r in parts.collect())
        shared.unpersist()
        return np.linalg.qr(np.vstack([np.frombuffer(r).reshape(-1, y.shape[1]) for _, r in factors]), mode="r")

    # --- the parts of a step

    def block(self, y: np.ndarray) -> np.ndarray:
        """Orthonormal directions that ``y`` adds to the basis."""
        for _ in range(3):
            for _ in range(2):
                y = y - self.v @ (self.v.T @ y)
            size = np.linalg.norm(y, axis=0)
            y = y[:, size > 0] / size[size > 0]
            if not y.shape[1]:
                break
            _, s, c = np.linalg.svd(self.triangle(y))
            keep = s > 1e-13 * s[0]
            keep[self.n - self.columns:] = False
            y = y @ (c[keep].T / s[keep])
            if s[keep].min() > 1e-3 * s[0]:         # else rounding has grown: once more, from directions close to the result
                break
        return y

    def extend(self, q: np.ndarray) -> None:
        """Add the directions ``q`` and their products."""
        c = self.columns
        self.v, self.w = np.hstack([self.v, q]), np.hstack([self.w, self.product(q)])
        t = np.zeros((self.columns, self.columns))
        t[:c, :c] = self.t
        t[:, c:] = self.v.T @ self.w[:, c:]
        t[c:, :c] = t[:c, c:].T
        t[c:, c:] = (t[c:, c:] + t[c:, c:].T) / 2
        self.t = t

    def rotate(self) -> tuple[np.ndarray, np.ndarray]:
        """Rayleigh-Ritz: the basis becomes the Ritz vectors, the largest value first. Returns the values
        and the norms of ``A A^T y - lam y``."""
        lam, c = np.linalg.eigh(self.t)
        lam, c = lam[::-1], c[:, ::-1]
        self.v, self.w, self.t = self.v @ c, self.w @ c, np.diag(lam)
        return lam, np.linalg.norm(self.w - self.v * lam, axis=0)

    def lock(self, kept: np.ndarray) -> None:
        """Only these columns stay in the basis."""
        self.v, self.w, self.t = self.v[:, kept], self.w[:, kept], self.t[np.ix_(kept, kept)]

    def filtered(self, x: np.ndarray, cut: float, degree: int) -> np.ndarray:
        """``T_degree(2 A A^T / cut - 1) x``, orthogonal to the basis after each product."""
        before, now = None, x
        for _ in range(degree):
            y = self.product(now)
            y *= 2 / cut
            y -= now
            if before is not None:
                y *= 2
                y -= before
            y -= self.v @ (self.v.T @ y)
            before, now = now, y
        return now

    def vectors(self, u: np.ndarray) -> DataFrame:
        """(p, u): panels of the thin block, the largest entry of each column positive; staged."""
        shared = self.spark.sparkContext.broadcast(u * np.where(u.max(axis=0) >= -u.min(axis=0), 1.0, -1.0))
        path = f"{self.path}/factors"
        self._panels(lambda p: {"p": p, "u": shared.value[p * PANEL_ROWS:(p + 1) * PANEL_ROWS]},
                     "p long, u binary").write.parquet(path)
        shared.unpersist()
        return self.spark.read.parquet(path)


def block_width(n: int, k: int) -> int:
    """Columns of the block: all items if they are few, else twice the rank as far as a block stays small."""
    wide = max(k + OVERSAMPLE, MIN_WIDTH, min(2 * k, BLOCK_CELLS // n))
    return n if n <= max(2 * wide, BASIS_COLUMNS) else wide


def filter_degree(top: float, cut: float, last: float = np.inf, need: float = np.inf) -> int:
    """Products after which the value ``last`` has grown by ``need`` over those below ``cut``, or the
    largest by ``GROWTH`` if that is sooner."""
    def degree(value: float, growth: float) -> float:
        return np.arccosh(max(growth, 1.0)) / np.arccosh(max(2 * value / cut - 1, 1 + 1e-12))
    wanted = degree(last, need) if np.isfinite(need) else np.inf
    return int(max(1, min(MAX_DEGREE, np.ceil(min(wanted, MAX_DEGREE)), degree(top, GROWTH))))


def block_svd(a: DataFrame, k: int | None, seed: int = 0) -> tuple[np.ndarray, DataFrame | None, np.ndarray]:
    """Item index, panels ``(p, u)`` and singular values; fewer than ``k`` only if
    the rank of ``a`` is less, with a warning. Fails after ``MAX_PRODUCTS`` products."""
    index = a.select("i").distinct().orderBy("i").toPandas()["i"].to_numpy()
    n = len(index)
    k = n if k is None else min(k, n)
    if k == 0:
        return index, None, np.zeros(0)
    run = Subspace(a, index)
    width = block_width(n, k)
    try:
        lam, u = run.spanned() if width == n and run.formed else _iterated(run, k, width, seed)
    finally:
        run.stored.unpersist()
    rank = int((lam[:k] > n * np.finfo(float).eps * max(lam[0], 0.0)).sum())
    if rank < k:
        warnings.warn(f"the matrix has rank {rank}: {rank} factors instead of {k}")
    return index, run.vectors(np.ascontiguousarray(u[:, :rank])), np.sqrt(lam[:rank])


def _iterated(run: Subspace, k: int, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of ``A A^T`` and their vectors, at least ``k``."""
    y, products = np.random.default_rng(seed).standard_normal((run.n, width)), 0
    while products < MAX_PRODUCTS:
        q = run.block(y)
        if q.shape[1]:
            run.extend(q)
            products += 1
        lam, off = run.rotate()
        scale = TOLERANCE * max(lam[0], 0.0)
        if not q.shape[1] or run.columns == run.n or (off[:k] <= scale).all():
            return lam, run.v
        loose = off > scale
        loose[k:] = True                        # beyond the rank: only there to widen the gap
        cut = max(lam[-1], 1e-8 * lam[0])
        degree = min(filter_degree(lam[loose][0], cut, lam[k - 1], SAFETY * off[:k].max() / scale),
                     MAX_PRODUCTS - products)
        x = run.v[:, loose]
        run.lock(~loose)
        y = run.filtered(x, cut, degree)
        products += degree
    raise RuntimeError(f"the SVD of rank {k} has not converged after {MAX_PRODUCTS} products")
