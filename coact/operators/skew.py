"""Joins that do not let one key land in one task.

A key is *heavy* if it has more than ``total / SHARE`` rows, so at most ``SHARE``
keys can be heavy: a bound that holds for every input, which is what allows a
broadcast of one row per heavy key. The rest is joined by key as usual, where
no key has more than that share of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coact.session import staged

SHARE = 2000
FLOOR = 1000        # rows that one task may always take for one key


def heavy_limit(total: int, share: int = SHARE, floor: int = FLOOR) -> int:
    """Rows of a key above which it is heavy; at most ``share`` keys are."""
    return max(floor, -(-total // share))


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int,
                how: str = "inner", share: int = SHARE, floor: int = FLOOR) -> DataFrame:
    """``rows`` joined with ``groups``, one row per key ``on`` whose number of
    rows in ``rows`` is the column ``size``; ``total`` is the sum over all keys.
    ``how``: inner or left. Null keys find no group."""
    limit = heavy_limit(total, share, floor)
    heavy = F.broadcast(groups.where(F.col(size) > limit))
    light = groups.where(F.col(size) <= limit)
    rest = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti")
    return rows.join(heavy, on).unionByName(rest.join(light, on, how))


def join_many(left: DataFrame, right: DataFrame, on: str, share: int = SHARE, floor: int = FLOOR) -> DataFrame:
    """Inner equi-join on one column that both sides may repeat.

    A frequency pass finds the keys that are heavy on either side. Their rows are
    dealt into blocks of about ``limit`` rows; each block of one side is copied to
    every block of the other, and the join runs on (key, block, block): every
    pair of rows meets once, and no task sees more than a block of either side
    for one key. Light keys are joined plainly, and the results are united.

    Both sides are read several times, so they should be tables in files. The heavy
    keys are staged: each join then carries that small table and not the frequency
    pass, and without heavy keys the join is the plain one.
    """
    l, r = ([c for c in d.columns if c != on] for d in (left, right))
    count = left.groupBy(on).agg(F.count("*").alias("_nl")).join(
        right.groupBy(on).agg(F.count("*").alias("_nr")), on)

    def limit(df: DataFrame):
        return F.greatest(F.lit(floor), F.ceil(df.agg(F.count("*")).scalar() / F.lit(share)))

    sized = count.select(on, F.ceil(F.col("_nl") / limit(left)).cast("int").alias("_bl"),
                         F.ceil(F.col("_nr") / limit(right)).cast("int").alias("_br"))
    kept = staged(sized.where((F.col("_bl") > 1) | (F.col("_br") > 1)), "heavy")
    if kept.isEmpty():
        return left.join(right, on)
    heavy = F.broadcast(kept)                                                      # at most 2 x share keys
    light = (left.join(heavy.select(on), on, "left_anti")
             .join(right.join(heavy.select(on), on, "left_anti"), on))

    def dealt(df: DataFrame, cols: list[str], own: str, other: str, own_key: str, other_key: str) -> DataFrame:
        return (df.join(heavy, on).withColumn(own_key, F.pmod(F.xxhash64(*cols), F.col(own)).cast("int"))
                .withColumn(other_key, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                .select(on, own_key, other_key, *cols))

    hot = (dealt(left, l, "_bl", "_br", "_x", "_y").join(dealt(right, r, "_br", "_bl", "_y", "_x"), [on, "_x", "_y"])
           .drop("_x", "_y"))
    return light.unionByName(hot)
