"""Dense ids without a one-task window.

``dense_rank() over (order by k)`` with no partition clause sends every row to
a single task.  The rank of a row only depends on its key, so we rank the
*distinct* keys and join the ids back.  Ranking the distinct keys is itself
done in parallel:

1. range-partition the distinct keys (Spark samples the bounds) into as many
   ranges as their number needs (``KEYS_PER_RANGE`` each, by a HyperLogLog
   count that is merged map-side), sort each partition;
2. ``monotonically_increasing_id`` then carries the partition number in its
   upper bits and the row's position inside the sorted partition in its lower
   33 bits;
3. per-partition sizes (one row per partition) are prefix-summed — a table
   bounded by the partition count, so a single small window is fine — and
   broadcast back.

Step 2's positions are only meaningful for one materialisation of the range
shuffle, so the sorted keys are persisted while they are read twice (sizes
and positions): both reads share one cached RDD whose lineage holds a single,
fixed range partitioner, so a block lost with an executor is recomputed into
the same partition with the same contents.  The finished ``(key, id)`` table
is then written as Parquet to the shared checkpoint folder and read back:
later plans see a deterministic leaf (ids never shift on recomputation, and
scalar subqueries over them stay deterministic), and the lineage is cut.

Ranks over a bounded candidate set (the top N items) use an ordinary window
instead; see :func:`rank_small`.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coact.session import scratch_dir

KEYS_PER_RANGE = 500_000
_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _order(col: str, descending: bool) -> Column:
    # Spark's defaults (ASC NULLS FIRST, DESC NULLS LAST) match SQL dense_rank.
    return F.col(col).desc() if descending else F.col(col).asc()


def range_count(keys: DataFrame, key: str) -> int:
    """Ranges for the distinct values of ``key``: their number follows the data, not a setting."""
    n = keys.agg(F.approx_count_distinct(key)).first()[0] or 0
    return max(1, -(-n // KEYS_PER_RANGE))


def dense_ids(keys: DataFrame, key: str, id_col: str, descending: bool = False,
              num_partitions: int | None = None) -> DataFrame:
    """Return ``(key, id_col)`` with ``id_col = dense_rank() over (order by key)``.

    ``keys`` may contain duplicates; ids start at 1 and have no gaps.
    """
    spark = keys.sparkSession
    n = num_partitions or range_count(keys, key)
    order = _order(key, descending)
    ranged = (keys.select(key).distinct()
              .repartitionByRange(n, order)
              .sortWithinPartitions(order)
              .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        mid = F.monotonically_increasing_id()
        tagged = ranged.select(key, F.shiftright(mid, _POS_BITS).alias("_part"),
                               mid.bitwiseAND(F.lit(_POS_MASK)).alias("_pos"))
        sizes = tagged.groupBy("_part").agg((F.max("_pos") + 1).alias("_n"))
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
        ids = tagged.join(F.broadcast(offsets), "_part").select(
            key, (F.col("_off") + F.col("_pos") + 1).cast("bigint").alias(id_col))
        path = scratch_dir(spark, f"ids-{id_col}")
        ids.write.mode("overwrite").parquet(path)
    finally:
        ranged.unpersist()
    return spark.read.parquet(path)


def attach_dense_ids(df: DataFrame, key: str, id_col: str, descending: bool = False,
                     keys: DataFrame | None = None, **kw) -> DataFrame:
    """``df`` with a dense-rank column over ``key`` (equi-join on the key).

    ``keys``: a cheaper table with the same distinct keys as ``df``, ranked in its place
    (``df`` may be a join that should not run a second time for the ranks).
    """
    ids = dense_ids(df if keys is None else keys, key, id_col, descending=descending, **kw).withColumnRenamed(key, "_key")
    # null-safe: a NULL key is one more group, as in SQL dense_rank
    return df.join(ids, df[key].eqNullSafe(ids["_key"])).drop("_key")


def rank_small(df: DataFrame, order: list[Column], id_col: str, fn=F.row_number) -> DataFrame:
    """Window rank over a table whose size is bounded by a parameter (e.g. top N)."""
    return df.withColumn(id_col, fn().over(Window.orderBy(*order)).cast("bigint"))
