"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``. A stage's result is
written as Parquet and read again as the next one's ``docs``; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coact.llm import decontam, line_dedup, minhash, packing, quality_rules
from coact.llm.common import prepare, staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned rules keep."""
    prepare(spark)
    return quality_rules.keep_good_documents(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; documents that lose every line
    go, and ``n_chars`` follows the text."""
    prepare(spark)
    count = "n_lines_removed"
    while count in docs.columns:
        count += "_"
    out = line_dedup.dedup_lines(docs, count_col=count)
    emptied = (F.col(count) > 0) & (F.col("text") == "")
    changed = F.when(F.col(count) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.where(~emptied).withColumn("n_chars", changed).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    prepare(spark)
    return minhash.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    prepare(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near-dedup", near_duplicates),
          ("decontamination", decontamination), ("packing", pack)]

#: Learned rules, tokens and packing are beyond SQL; tests/llm check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, out, sf_dir)
        if k < len(STAGES) - 1:
            out = staged(out, f"pipeline{k}")
    return out
