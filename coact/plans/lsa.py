"""LSA batch: log -> activity tables -> log-entropy weighting -> truncated SVD ->
latent similarity top-k -> item profile with latent vectors.

The weighted matrix stays distributed; the only driver step is the factor
matrix (items x rank), bounded by the band's ``top_n`` and the rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coact.operators import factor as fc
from coact.operators.activity import ActivityModel, Band
from coact.operators.weighting import log_entropy

# The LSA batch configuration (top items, user band, SVD rank, related per item).
LSA_BAND = Band(top_n=50000, min_items=5, max_items=100)
LSA_RANK = 300
LSA_K = 20


def weighted_matrix(model: ActivityModel) -> DataFrame:
    """``a_ij = ln(1 + |tf_ij|) * w_i`` over the band's frequency matrix (staged:
    the SVD, the fold-in and the power iteration all read it)."""
    return model.stage("weighted", log_entropy(model.matrix, row_bound=model.band.top_n))


def factors(model: ActivityModel, rank: int | None = LSA_RANK) -> fc.Factors:
    return fc.truncated_svd(weighted_matrix(model), rank)


def related(spark: SparkSession, model: ActivityModel, f: fc.Factors, k: int = LSA_K) -> DataFrame:
    """``item, related, rk, sim`` in the latent space (self excluded)."""
    names = model.item_names
    top = fc.latent_similarity_topk(spark, f, k)
    return (top.join(F.broadcast(names), "i")
               .join(F.broadcast(names.select(F.col("i").alias("j"), F.col("item").alias("related"))), "j")
               .select("item", "related", "rk", "sim"))


def vectors(spark: SparkSession, model: ActivityModel, f: fc.Factors) -> DataFrame:
    """``item, vector`` = the latent row ``L[i]`` of every item."""
    return fc.factors_frame(spark, f).join(F.broadcast(model.item_names), "i").select("item", "vector")

