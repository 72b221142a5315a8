"""CF batch: log -> activity tables -> item cosine similarity -> top-k related.

One DataFrame plan from the log to ``(item, related, rk, sim)``; the only
materialisations are the persisted pair table (read by several branches) and
the checkpointed id tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from coact.operators.activity import ActivityModel, Band
from coact.operators.similarity import cosine_similarity, top_k_per_row

# The CF batch configuration (top items, user band, related per item).
CF_BAND = Band(top_n=500, min_items=5, max_items=30)
CF_K = 10


def item_similarity(model: ActivityModel) -> DataFrame:
    """Cosine similarity of the item rows of the frequency matrix, ``(i, j, value)``.

    Joins on the user name (``model.named``): no dense user ids are needed.
    """
    return cosine_similarity(model.named, axis="rows", row_bound=model.band.top_n)


def top_k_related(model: ActivityModel, k: int = CF_K) -> DataFrame:
    """``item, related, rk, sim``: the k most similar other items of every top item."""
    return top_k_per_row(item_similarity(model), k, names=model.item_names,
                         name_bound=model.band.top_n)
