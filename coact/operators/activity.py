"""Activity tables: from the log to the item x user frequency matrix.

One aggregation over the log (:func:`pair_activity`) produces every per
(item, user) statistic the later tables need — net votes, comment count, net
score and absolute score — so the log is scanned and shuffled exactly once.
The reference filters the log on top items and valid users *before* grouping;
both filters are on group keys, so grouping first and filtering the (much
smaller) pair table after is the same result with one shuffle instead of two.

Tables (neutral names: item = subreddit, user = author):

==================  ====================================================
``pairs``           item, user, net_votes, comments, net_score, abs_score
``occurrences``     pairs with net_votes != 0, plus ``uid`` / ``rid`` ids
``item_activity``   item, rid, activity (= sum of comments)
``top``             the N most active items, ``item_id`` 1..N
``valid_users``     users with a bounded number of top items
``pruned``          pairs of top items x valid users, net_score != 0, ``uid``
``matrix``          ``(i, j, value)`` = (item_id - 1, uid, net_score)
==================  ====================================================
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coact.operators.ids import attach_dense_ids, dense_ids, rank_small
from coact.sources.log import spread

# Top-N candidate tables are at most this many rows before we stop forcing a
# broadcast and let the planner / AQE decide from measured sizes.
BROADCAST_ROW_LIMIT = 2_000_000


@dataclass(frozen=True)
class Band:
    """Selection parameters: top ``top_n`` items, users with
    ``min_items <= #top items <= max_items``."""
    top_n: int = 50
    min_items: int = 5
    max_items: int = 30


def bounded_broadcast(df: DataFrame, row_bound: int) -> DataFrame:
    """Broadcast ``df`` only when its row count is bounded by a small parameter."""
    return F.broadcast(df) if row_bound <= BROADCAST_ROW_LIMIT else df


def pair_activity(log: DataFrame, tasks: int | None = None) -> DataFrame:
    """Per (item, user): sum(sign(score)), count(score), sum(score), sum(|score|).

    With ``tasks`` the log rows themselves are shuffled, over so many tasks: most pairs are rare, so
    a map-side sum holds nearly a group per row and saves little of the shuffle."""
    return (spread(log, tasks, "subreddit", "author").groupBy(F.col("subreddit").alias("item"), F.col("author").alias("user"))
               .agg(F.sum(F.signum("score")).cast("bigint").alias("net_votes"),
                    F.count("score").cast("bigint").alias("comments"),
                    F.sum("score").cast("bigint").alias("net_score"),
                    F.sum(F.abs("score")).cast("bigint").alias("abs_score")))


def item_user_activity(pairs: DataFrame) -> DataFrame:
    """The reference's ``occurrences``: pairs with net votes != 0.

    ``uid`` = dense rank of the user, descending, over *all* grouped pairs
    (before the filter, so ids may have gaps); ``rid`` = dense rank of the item,
    descending, after the filter.
    """
    with_uid = attach_dense_ids(pairs.select("item", "user", "net_votes", "comments"),
                                "user", "uid", descending=True)
    # the item ranks come from the pairs themselves, so the user-id join runs once
    return attach_dense_ids(with_uid.where(F.col("net_votes") != 0), "item", "rid", descending=True,
                            keys=pairs.where(F.col("net_votes") != 0))


def item_activity(occ: DataFrame) -> DataFrame:
    """Per item: total comment count over its non-zero pairs (``rid`` kept if present)."""
    keys = ["item", "rid"] if "rid" in occ.columns else ["item"]
    return occ.groupBy(*keys).agg(F.sum("comments").cast("bigint").alias("activity"))


def most_active_items(occ: DataFrame, top_n: int) -> DataFrame:
    """Reference semantics: ``ordered_id = dense_rank(activity desc) <= N``.

    Ties share an id and are all kept, so more than N items may come back.
    Only the N largest *distinct* activity values are ranked (a bounded table),
    then joined back to the items.
    """
    act = item_activity(occ)
    levels = act.select("activity").distinct().orderBy(F.desc("activity")).limit(top_n)
    levels = rank_small(levels, [F.desc("activity")], "ordered_id")
    return act.join(bounded_broadcast(levels, top_n), "activity").select(
        "item", "rid", "activity", "ordered_id")


def top_items(occ: DataFrame, top_n: int) -> DataFrame:
    """Exactly N items with a unique ``item_id``: activity desc, then name asc.

    Used for the matrix rows (the reference's dense rank would merge tied items
    into one row).  ``TakeOrderedAndProject`` keeps N rows per partition, so the
    ranking window only ever sees N rows.
    """
    act = item_activity(occ).select("item", "activity")
    best = act.orderBy(F.desc("activity"), F.asc("item")).limit(top_n)
    return rank_small(best, [F.desc("activity"), F.asc("item")], "item_id")


def valid_users(occ: DataFrame, top: DataFrame, band: Band, tasks: int | None = None) -> DataFrame:
    """Users active in between ``min_items`` and ``max_items`` of the top items."""
    in_top = occ.join(bounded_broadcast(top.select("item"), band.top_n), "item", "left_semi").select("item", "user")
    return (spread(in_top, tasks, "user").groupBy("user").agg(F.count("item").cast("bigint").alias("n_items"))
                  .where(F.col("n_items").between(band.min_items, band.max_items)))


def kept_pairs(pairs: DataFrame, top: DataFrame, users: DataFrame, top_n: int,
               tasks: int | None = None) -> DataFrame:
    """Pairs of top items x valid users (before the score filter); ``uid`` if ``users`` has it.

    An inner join, as ``users`` has a row per user: a semi join is pushed below the join with the
    top items, and then the pairs of all items are shuffled."""
    ids = [c for c in users.columns if c == "uid"]
    in_top = pairs.join(bounded_broadcast(top.select("item", "item_id"), top_n), "item")
    return (spread(in_top.select("item", "user", "item_id", "net_score", "abs_score"), tasks, "user")
            .join(users.select("user", *ids), "user")
            .select("item", "user", "item_id", "net_score", "abs_score", *ids))


def pruned_activity(pairs: DataFrame, top: DataFrame, users: DataFrame, top_n: int,
                    tasks: int | None = None) -> DataFrame:
    """Pairs of top items x valid users with net score != 0.

    ``uid`` = dense rank of the user, descending, over the kept pairs before
    the score filter (reference semantics).  These are the valid users (each has
    a pair with a top item), so they are ranked, not the pairs.
    """
    ids = dense_ids(users.where(F.col("user").isNotNull()), "user", "uid", descending=True)
    return kept_pairs(pairs, top, ids, top_n, tasks).where(F.col("net_score") != 0)


def named_matrix(kept: DataFrame) -> DataFrame:
    """The frequency matrix keyed by user *name* (``j = user``).

    Operators that only join on the column index (products, cosine, norms)
    need no dense user ids; this form skips ranking the users entirely.
    """
    return kept.where(F.col("net_score") != 0).select(
        (F.col("item_id") - 1).cast("bigint").alias("i"), F.col("user").alias("j"),
        F.col("net_score").cast("double").alias("value"))


def frequency_matrix(pruned: DataFrame) -> DataFrame:
    """Item x user matrix in coordinate form: rows ``item_id - 1``, columns ``uid``."""
    return pruned.select((F.col("item_id") - 1).cast("bigint").alias("i"),
                         F.col("uid").cast("bigint").alias("j"),
                         F.col("net_score").cast("double").alias("value"))


@dataclass
class ActivityModel:
    """All activity tables of one log and one band, built lazily.

    With ``stage_dir`` (a folder under the shared checkpoint directory) every
    table is *staged* on first use: written once as Parquet and read back.
    A table such as the pair aggregate or the pruned matrix feeds many later
    plans — including scalar subqueries, which never share exchanges with
    the main plan — so without staging each consumer would re-derive it from
    the log.  Staging also cuts lineage: after a lost executor Spark re-reads
    the written files instead of re-running the log scan and join, and the
    dense-id columns can never shift on recomputation.  (Caching in memory
    instead defeats AQE's exchange reuse and makes concurrent stages queue on
    half-built cache blocks.)  Without ``stage_dir`` the tables stay lazy.
    """
    log: DataFrame
    band: Band
    stage_dir: str | None = None
    tasks: int | None = None        # of the joins and groups of all pairs; None: as Spark sets them

    def __post_init__(self):
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name, build, stage: bool = True):
        if name not in self._cache:
            df = build()
            if stage and self.stage_dir:
                path = f"{self.stage_dir.rstrip('/')}/{name}"
                df.write.mode("overwrite").parquet(path)
                df = df.sparkSession.read.parquet(path)
            self._cache[name] = df
        return self._cache[name]

    @property
    def pairs(self) -> DataFrame:
        return self._get("pairs", lambda: pair_activity(self.log, self.tasks))

    @property
    def occurrences(self) -> DataFrame:
        return self._get("occ", lambda: item_user_activity(self.pairs))

    @property
    def occ_nonzero(self) -> DataFrame:
        """Pairs with net votes != 0, without the id columns (cheaper upstream)."""
        return self._get("occ_nz", lambda: self.pairs.where(F.col("net_votes") != 0)
                         .select("item", "user", "comments"), stage=False)

    @property
    def top(self) -> DataFrame:
        return self._get("top", lambda: top_items(self.occ_nonzero, self.band.top_n))

    @property
    def users(self) -> DataFrame:
        return self._get("users", lambda: valid_users(self.occ_nonzero, self.top, self.band, self.tasks))

    @property
    def kept(self) -> DataFrame:
        """Pairs of top items x valid users before the score filter, no user ids."""
        return self._get("kept", lambda: kept_pairs(self.pairs, self.top, self.users, self.band.top_n,
                                                     self.tasks))

    @property
    def kept_nonzero(self) -> DataFrame:
        """``item, user, item_id, net_score, abs_score`` with net score != 0 (no ids)."""
        return self._get("kept_nz", lambda: self.kept.where(F.col("net_score") != 0), stage=False)

    @property
    def pruned(self) -> DataFrame:
        """The kept non-zero pairs with the reference's dense user id ``uid``."""
        return self._get("pruned", lambda: pruned_activity(self.pairs, self.top, self.users,
                                                           self.band.top_n, self.tasks))

    @property
    def named(self) -> DataFrame:
        """Frequency matrix with the user name as column key (no id ranking)."""
        return self._get("named", lambda: named_matrix(self.kept), stage=False)

    @property
    def matrix(self) -> DataFrame:
        return self._get("matrix", lambda: frequency_matrix(self.pruned), stage=False)

    @property
    def item_names(self) -> DataFrame:
        """Dimension table ``(i, item)`` for the matrix rows (bounded by N)."""
        return self._get("names", lambda: self.top.select(
            (F.col("item_id") - 1).cast("bigint").alias("i"), "item"), stage=False)

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Stage any derived table of this model (e.g. a weighted matrix) under ``name``."""
        return self._get(name, lambda: df)

    def materialize(self) -> "ActivityModel":
        """Stage the pair table now (one pass over the log)."""
        self.pairs
        return self

    def unpersist(self):
        self._cache.clear()
