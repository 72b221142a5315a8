"""Sparse matrices as DataFrames ``(i long, j long, value double)``.

A vector is ``(i long, value double)``.  Every operator is a projection, a
filter, a join on the coordinates or a grouped aggregate, so Catalyst plans
them (broadcast vs shuffle, partial aggregation, codegen) and nothing is ever
collected into a local array.  Shapes are implied: ``rows = max(i) + 1``,
``cols = max(j) + 1``, as for an mllib ``CoordinateMatrix``.

Duplicate coordinates mean "sum" everywhere (:func:`coalesce_duplicates`).
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coact.operators.skew import join_many

MATRIX_SCHEMA = T.StructType([
    T.StructField("i", T.LongType(), False),
    T.StructField("j", T.LongType(), False),
    T.StructField("value", T.DoubleType(), True),
])


def entries(df: DataFrame, i="i", j="j", value="value") -> DataFrame:
    """Normalise column names and types to a matrix DataFrame."""
    return df.select(F.col(i).cast("bigint").alias("i"), F.col(j).cast("bigint").alias("j"),
                     F.col(value).cast("double").alias("value"))


def from_rows(spark: SparkSession, rows) -> DataFrame:
    """Matrix from a small in-memory list of ``(i, j, value)`` (tests, fixtures)."""
    return spark.createDataFrame([(int(a), int(b), float(c)) for a, b, c in rows], MATRIX_SCHEMA)


def from_dense_rows(df: DataFrame, row_col: str, array_col: str) -> DataFrame:
    """Dense rows (one array per row) -> sparse entries, zeros dropped."""
    return (df.select(F.col(row_col).cast("bigint").alias("i"),
                      F.posexplode(array_col).alias("j", "value"))
              .where(F.col("value") != 0)
              .select("i", F.col("j").cast("bigint").alias("j"),
                      F.col("value").cast("double").alias("value")))


def coalesce_duplicates(m: DataFrame) -> DataFrame:
    return m.groupBy("i", "j").agg(F.sum("value").alias("value"))


# --- shape and inspection -------------------------------------------------

def shape(m: DataFrame) -> DataFrame:
    """One row: ``n_rows, n_cols, nnz`` (implied shape)."""
    return m.agg((F.max("i") + 1).cast("bigint").alias("n_rows"),
                 (F.max("j") + 1).cast("bigint").alias("n_cols"),
                 F.count(F.lit(1)).cast("bigint").alias("nnz"))


def nnz(m: DataFrame) -> DataFrame:
    return m.agg(F.count(F.lit(1)).cast("bigint").alias("nnz"))


def nan_count(m: DataFrame) -> DataFrame:
    return m.agg(F.coalesce(F.sum(F.isnan("value").cast("bigint")), F.lit(0))
                 .cast("bigint").alias("nan_count"))


def take_first(m: DataFrame, n: int) -> DataFrame:
    """The first ``n`` entries under the total order (i, j) — a peek, the limit is the feature."""
    return m.orderBy("i", "j").limit(n)


# --- structural operators --------------------------------------------------

def transpose(m: DataFrame) -> DataFrame:
    return m.select(F.col("j").alias("i"), F.col("i").alias("j"), "value")


def diagonal(m: DataFrame) -> DataFrame:
    """Vector of the stored diagonal entries."""
    return m.where(F.col("i") == F.col("j")).select("i", "value")


def row(m: DataFrame, k: int) -> DataFrame:
    """Row ``k`` re-indexed as row 0."""
    return m.where(F.col("i") == F.lit(k)).select(F.lit(0).cast("bigint").alias("i"), "j", "value")


def drop_first(m: DataFrame) -> DataFrame:
    """``mat[1:, 1:]``: drop row 0 and column 0, shift both indices down by one."""
    return m.where((F.col("i") >= 1) & (F.col("j") >= 1)).select(
        (F.col("i") - 1).alias("i"), (F.col("j") - 1).alias("j"), "value")


RANGE_CHUNK = 65536


def expand_range(df: DataFrame, n: Column, out: str, chunk: int = RANGE_CHUNK,
                 keep: list[str] | None = None) -> DataFrame:
    """Every row of ``df`` repeated for ``out = 0 .. n - 1``, generated in parallel.

    A long range would explode inside the one task holding its row, so the
    range is first cut into chunks of ``chunk`` values; the (small) chunk rows
    are repartitioned across tasks and only then expanded.
    """
    keep = keep or [c for c in df.columns]
    nn = n.cast("bigint")
    last_chunk = F.floor((F.col("_n") - 1) / F.lit(chunk)).cast("bigint")
    chunks = df.select(*keep, nn.alias("_n")).where(F.col("_n") > 0).select(
        *keep, "_n", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)).alias("_c"))
    spread = chunks.repartition(*[F.col(c) for c in keep], F.col("_c")) if keep else chunks.repartition("_c")
    lo = F.col("_c") * F.lit(chunk)
    hi = F.least(F.col("_n"), lo + F.lit(chunk)) - 1
    return spread.select(*keep, F.explode(F.sequence(lo, hi)).alias(out))


def identity(m: DataFrame) -> DataFrame:
    """Identity of size ``min(rows, cols)`` of ``m``'s implied shape."""
    dims = shape(m).select(F.least("n_rows", "n_cols").alias("n"))
    return (expand_range(dims, F.col("n"), "i", keep=[])
                .select("i", F.col("i").alias("j"), F.lit(1.0).alias("value")))


def densify(m: DataFrame, n_rows: Column | int | None = None,
            n_cols: Column | int | None = None) -> DataFrame:
    """Every cell of the implied shape, missing = 0 (one row per cell).

    The output is the dense matrix, so it is rows x cols by definition; each
    matrix row expands its own column range, there is no cross join.
    """
    dims = shape(m)
    nr = F.lit(n_rows) if isinstance(n_rows, int) else (n_rows if n_rows is not None else F.col("n_rows"))
    nc = F.lit(n_cols) if isinstance(n_cols, int) else (n_cols if n_cols is not None else F.col("n_cols"))
    rows = expand_range(dims.select(nr.alias("nr"), nc.alias("nc")), F.col("nr"), "i", keep=["nc"])
    cells = expand_range(rows, F.col("nc"), "j", keep=["i"])
    summed = coalesce_duplicates(m)
    return (cells.join(summed, ["i", "j"], "left")
                 .select("i", "j", F.coalesce("value", F.lit(0.0)).alias("value")))


def vector_densify(v: DataFrame, size: int | None = None) -> DataFrame:
    """Sparse vector -> every index ``0..size-1`` with missing = 0."""
    dims = v.agg((F.max("i") + 1).alias("n"))
    n = F.lit(size) if size is not None else F.col("n")
    idx = expand_range(dims.select(n.alias("n")), F.col("n"), "i", keep=[])
    summed = v.groupBy("i").agg(F.sum("value").alias("value"))
    return idx.join(summed, "i", "left").select("i", F.coalesce("value", F.lit(0.0)).alias("value"))


def vector_from_dense(df: DataFrame, array_col: str) -> DataFrame:
    """Dense array (one row) -> sparse vector, zeros dropped."""
    return (df.select(F.posexplode(array_col).alias("i", "value"))
              .where(F.col("value") != 0)
              .select(F.col("i").cast("bigint").alias("i"), F.col("value").cast("double").alias("value")))


# --- element-wise ------------------------------------------------------------

def map_values(m: DataFrame, op: Callable[[Column], Column]) -> DataFrame:
    """``op`` applied to every stored entry (a Column expression: stays in codegen)."""
    return m.select("i", "j", op(F.col("value")).cast("double").alias("value"))


def map_values_udf(m: DataFrame, fn: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """Same, for an opaque Python function: an Arrow-batched pandas UDF."""
    udf = F.pandas_udf(fn, T.DoubleType())
    return m.select("i", "j", udf(F.col("value")).alias("value"))


def vector_map_values(v: DataFrame, op: Callable[[Column], Column]) -> DataFrame:
    return v.select("i", op(F.col("value")).cast("double").alias("value"))


def add_constant(m: DataFrame, c: float) -> DataFrame:
    """Add ``c`` to the stored (non-zero) entries only."""
    return map_values(m, lambda v: v + F.lit(float(c)))


def scalar_multiply(m: DataFrame, c: float) -> DataFrame:
    return map_values(m, lambda v: v * F.lit(float(c)))


# --- binary operators --------------------------------------------------------

def add(left: DataFrame, right: DataFrame, scalar: float = 1.0) -> DataFrame:
    """``left + scalar * right``; a cell missing on one side counts as 0."""
    r = right.select("i", "j", (F.col("value") * F.lit(float(scalar))).alias("rv"))
    l = left.select("i", "j", F.col("value").alias("lv"))
    return (l.join(r, ["i", "j"], "full_outer")
             .select("i", "j", (F.coalesce("lv", F.lit(0.0)) + F.coalesce("rv", F.lit(0.0))).alias("value")))


def hadamard(left: DataFrame, right: DataFrame) -> DataFrame:
    """Element-wise product on the common cells."""
    r = right.select("i", "j", F.col("value").alias("rv"))
    return left.join(r, ["i", "j"]).select("i", "j", (F.col("value") * F.col("rv")).alias("value"))


def row_divide(m: DataFrame, vec: DataFrame) -> DataFrame:
    """``m[i, j] / vec[i]``; rows without a vector entry drop out."""
    v = vec.select("i", F.col("value").alias("d"))
    return m.join(v, "i").select("i", "j", (F.col("value") / F.col("d")).alias("value"))


def row_scale(m: DataFrame, vec: DataFrame) -> DataFrame:
    """``m[i, j] * vec[i]``; rows without a vector entry drop out."""
    v = vec.select("i", F.col("value").alias("w"))
    return m.join(v, "i").select("i", "j", (F.col("value") * F.col("w")).alias("value"))


def multiply(left: DataFrame, right: DataFrame, zero_threshold: float = 0.0, **skew) -> DataFrame:
    """Sparse product: join ``left.j = right.i``, multiply, sum per ``(left.i, right.j)``.

    Entries with ``|value| < zero_threshold`` are dropped (0 keeps all, zeros too).
    The join key is the contraction index; heavy ones are dealt in blocks
    (:func:`coact.operators.skew.join_many`, which takes ``skew``), and HashAggregate
    combines map-side.
    """
    l = left.select(F.col("i").alias("li"), F.col("j").alias("k"), F.col("value").alias("lv"))
    r = right.select(F.col("i").alias("k"), F.col("j").alias("rj"), F.col("value").alias("rv"))
    prod = (join_many(l, r, "k", **skew).groupBy("li", "rj").agg(F.sum(F.col("lv") * F.col("rv")).alias("value"))
              .select(F.col("li").alias("i"), F.col("rj").alias("j"), "value"))
    return prod.where(F.abs("value") >= F.lit(float(zero_threshold)))


def multiply_at(left: DataFrame, right: DataFrame, cells: DataFrame, **skew) -> DataFrame:
    """The sparse product only at the requested ``cells`` (i, j), each once; a cell
    whose row and column share no index is left out (its value is 0).

    A cell meets the entries of its column of ``right`` and then the one entry of
    ``left`` that each needs: cells x column length rows, and no product beyond them.
    """
    c = cells.select("i", "j").distinct()
    r = right.select(F.col("i").alias("k"), "j", F.col("value").alias("rv"))
    l = left.select("i", F.col("j").alias("k"), F.col("value").alias("lv"))
    return (join_many(c, r, "j", **skew).join(l, ["i", "k"])
            .groupBy("i", "j").agg(F.sum(F.col("lv") * F.col("rv")).alias("value")))


# --- reductions --------------------------------------------------------------

def row_sum(m: DataFrame) -> DataFrame:
    return m.groupBy("i").agg(F.sum("value").alias("value"))


def row_abs_sum(m: DataFrame) -> DataFrame:
    return m.groupBy("i").agg(F.sum(F.abs("value")).alias("value"))


def row_norms(m: DataFrame) -> DataFrame:
    """Euclidean norm of every row as a vector ``(i, value)``."""
    return m.groupBy("i").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("value"))


def vector_norm(v: DataFrame) -> DataFrame:
    return v.agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))


def column_std(m: DataFrame, n_rows: int | Column | None = None) -> DataFrame:
    """Population std of every column, implicit zeros included.

    ``sqrt(sum(v^2)/n - (sum(v)/n)^2)`` with ``n`` = the full number of rows
    (``stddev_pop`` over stored entries would skip the zeros).
    """
    n = _dim(m, "i", n_rows)
    s = m.groupBy("j").agg(F.sum("value").alias("s1"),
                           F.sum(F.col("value") * F.col("value")).alias("s2")).withColumn("n", n)
    mean = F.col("s1") / F.col("n")
    return s.select(F.col("j").alias("i"),
                    F.sqrt(F.greatest(F.col("s2") / F.col("n") - mean * mean, F.lit(0.0))).alias("value"))


def scale_columns_to_unit_std(m: DataFrame, epsilon: float = 1e-9, col_bound: int | None = None) -> DataFrame:
    """Columns divided by ``epsilon + std`` (population std, implicit zeros counted).

    ``col_bound`` (a proven bound on the number of columns) allows broadcasting the stds.
    """
    std = column_std(m).select(F.col("i").alias("j"), F.col("value").alias("sd"))
    std = F.broadcast(std) if col_bound is not None and col_bound <= 2_000_000 else std
    return m.join(std, "j").select(
        "i", "j", (F.col("value") / (F.lit(epsilon) + F.col("sd"))).alias("value"))


def _dim(m: DataFrame, axis: str, given) -> Column:
    """A dimension as a Column: given, or the implied ``max(axis) + 1`` (scalar subquery)."""
    if given is None:
        return m.agg((F.max(axis) + 1).cast("double").alias("n")).scalar()
    return F.lit(float(given)) if isinstance(given, (int, float)) else given.cast("double")


def rows_packed(m: DataFrame) -> DataFrame:
    """Each row's entries as parallel, index-sorted arrays (a sparse vector).

    Only for rows of bounded length (e.g. user rows under the activity band);
    an item row of a big log would be an unbounded group.
    """
    return (m.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "value"))).alias("e"))
             .select("i", F.col("e.j").alias("indices"), F.col("e.value").alias("values")))


# --- vectors -------------------------------------------------------------------

def unit_distance(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """``|| v1/|v1| - v2/|v2| ||`` (one row, column ``distance``)."""
    n1 = vector_norm(v1).scalar()
    n2 = vector_norm(v2).scalar()
    a = v1.select("i", (F.col("value") / n1).alias("a"))
    b = v2.select("i", (F.col("value") / n2).alias("b"))
    d = a.join(b, "i", "full_outer").select(
        (F.coalesce("a", F.lit(0.0)) - F.coalesce("b", F.lit(0.0))).alias("d"))
    return d.agg(F.sqrt(F.sum(F.col("d") * F.col("d"))).alias("distance"))


def rows_by_distance(m: DataFrame, vec: DataFrame) -> DataFrame:
    """Every row id with ``|r - v|^2 / (|r| |v|)``, ascending.

    ``|r - v|^2 = |r|^2 + |v|^2 - 2 r.v``; ``r.v`` is a join on the column index.
    """
    v = vec.select(F.col("i").alias("j"), F.col("value").alias("vv"))
    vsq = vec.agg(F.sum(F.col("value") * F.col("value")).alias("vsq")).scalar()
    dots = m.join(v, "j").groupBy("i").agg(F.sum(F.col("value") * F.col("vv")).alias("dot"))
    rsq = m.groupBy("i").agg(F.sum(F.col("value") * F.col("value")).alias("rsq"))
    return rsq.join(dots, "i", "left").select(
        "i", ((F.col("rsq") + vsq - 2 * F.coalesce("dot", F.lit(0.0)))
              / (F.sqrt("rsq") * F.sqrt(vsq))).alias("distance"))
