"""The comment log: schema, JSON reader and adapters from the driver tables.

The log is a row table ``author string, score long, subreddit string`` (all
nullable).  Any other field of the JSON is dropped by the fixed read schema, so
the scan only materialises three columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The log's field names and types.
LOG_SCHEMA = T.StructType([
    T.StructField("author", T.StringType(), True),
    T.StructField("score", T.LongType(), True),
    T.StructField("subreddit", T.StringType(), True),
])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of the log that one task takes in the joins and groups of all its rows; the rows of a
#: default partition grow with the data, as their target is in compressed bytes.
ROWS_PER_TASK = 250_000
# The table that gives one log row per row.
LOG_TABLES = {"orders": "lineitem", "events": "events"}


def log_tasks(spark: SparkSession, sf_dir: str, adapter: str = "orders") -> int | None:
    """Tasks that the log's rows need (``None``: no more than there are cores). The count reads footers only."""
    n = -(-read_table(spark, sf_dir, LOG_TABLES[adapter]).count() // ROWS_PER_TASK)
    return n if n > spark.sparkContext.defaultParallelism else None


def spread(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """``df`` by ``keys`` over ``tasks`` tasks, as it is without a number."""
    return df.repartition(tasks, *keys) if tasks else df


def read_json_log(spark: SparkSession, path: str) -> DataFrame:
    """Read JSON lines with the fixed three-field log schema (local, HDFS or s3a)."""
    return spark.read.schema(LOG_SCHEMA).json(path)


def log_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter A: one log row per line item.

    user = ``c<o_custkey>``, item = ``s<l_suppkey>``, score = quantity, negated
    for returned lines.  lineitem x orders is the one large join of the whole
    library; only the four columns it needs are read from either table.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_returnflag")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    tasks = log_tasks(spark, sf_dir, "orders")
    li, od = spread(li, tasks, "l_orderkey"), spread(od, tasks, "o_orderkey")
    sign = F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1))
    return (li.join(od, li.l_orderkey == od.o_orderkey)
              .select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("author"),
                      (F.col("l_quantity").cast("bigint") * sign).cast("bigint").alias("score"),
                      F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("subreddit")))


def log_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter B: one log row per event; the item comes out of a JSON field.

    user = ``u<user_id>``, item = ``k<props.k>``, score = floor(value), negated
    for error events.
    """
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_type", "value", "props")
    sign = F.when(F.col("event_type") == "error", F.lit(-1)).otherwise(F.lit(1))
    return ev.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("author"),
        (F.floor("value").cast("bigint") * sign).cast("bigint").alias("score"),
        F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("subreddit"))


ADAPTERS = {"orders": log_from_orders, "events": log_from_events}


def load_log(spark: SparkSession, sf_dir: str, adapter: str = "orders") -> DataFrame:
    return ADAPTERS[adapter](spark, sf_dir)
