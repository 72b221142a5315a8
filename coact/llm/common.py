"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coact.session import ensure_checkpoint_dir, scratch_dir, ship_package

#: Words everywhere in this subpackage: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_WORDS = re.compile(WORD)

#: Rows in one Arrow batch, so that a batch of long texts stays small.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators rely on: shared folder, this package on the workers, small batches."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and a
    lost executor costs a re-read of files only."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


#: What this Python worker remembers, of one operator at a time.
_held: list = []


def hold(cache) -> None:
    """Keep ``cache`` (anything with ``clear``) and forget what other operators
    left in this worker: Spark uses a worker again in later stages, and what
    they remember would add up."""
    if not (_held and _held[0] is cache):
        for old in _held:
            old.clear()
        _held[:] = [cache]
        pa.default_memory_pool().release_unused()


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text) if text else []


def crc_mod(column: Column, modulus: int) -> Column:
    """crc32 of the id's text form, modulo ``modulus`` (null id: null)."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(modulus)


def held_out(column: Column, modulus: int, remainder: int) -> Column:
    """True for the held-out fold; a null id is never held out."""
    return F.coalesce(crc_mod(column, modulus) == F.lit(remainder), F.lit(False))


def row_key(*columns: Column) -> Column:
    """64-bit key that also keeps null apart from every value."""
    parts = []
    for c in columns:
        parts += [c.isNull(), c]
    return F.xxhash64(*parts)
