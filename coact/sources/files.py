"""File sources and sinks: JSON (fixed or inferred schema), delimited text,
rating / user / seen-item CSVs and Parquet.

Readers take an explicit schema wherever the reference had a fixed one, so a
scan never needs an inference pass over the data; the inferred-schema reader
exposes ``samplingRatio`` for large inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coact.sources.log import LOG_SCHEMA

# Schemas of the delimited inputs: ids and values as wide as this engine writes them.
PEOPLE_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), True),
    T.StructField("age", T.IntegerType(), True),
])
RATING_SCHEMA = T.StructType([
    T.StructField("user", T.LongType(), True),
    T.StructField("item", T.LongType(), True),
    T.StructField("rating", T.DoubleType(), True),
])
USER_SCHEMA = T.StructType([T.StructField("user", T.LongType(), True)])
SEEN_SCHEMA = T.StructType([
    T.StructField("user", T.LongType(), True),
    T.StructField("item", T.LongType(), True),
])


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).json(path)


def read_json_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """JSON with an inferred (possibly nested) schema."""
    return spark.read.option("samplingRatio", sampling_ratio).json(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """Plain delimited text, no header (what a ``textFile`` + ``split`` reader expects)."""
    df.write.mode("overwrite").option("sep", sep).option("header", "false").csv(path)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Split every line on ``sep`` and cast the fields by the given schema."""
    return spark.read.schema(schema).option("sep", sep).option("header", "false").csv(path)


def read_people(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, PEOPLE_SCHEMA)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Rating triples ``user, item, rating`` -> matrix ``(i = user, j = item, value)``."""
    r = read_delimited(spark, path, RATING_SCHEMA)
    return r.select(F.col("user").alias("i"), F.col("item").alias("j"), F.col("rating").alias("value"))


def read_target_users(spark: SparkSession, path: str) -> DataFrame:
    """The set of target users: column 0 of a CSV, distinct."""
    return read_delimited(spark, path, USER_SCHEMA).select("user").distinct()


def read_seen_items(spark: SparkSession, path: str) -> DataFrame:
    """Seen items per user ``(user, items array<bigint>)`` (sorted)."""
    seen = read_delimited(spark, path, SEEN_SCHEMA)
    return seen.groupBy("user").agg(F.sort_array(F.collect_list("item")).alias("items"))


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
