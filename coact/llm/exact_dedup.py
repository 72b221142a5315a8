"""Exact duplicates by an extendible-hash index on shared files.

Texts are equal when they are identical after each run of ASCII white space is
replaced by one space. Keys are 64-bit hashes of the normalised text.

1. *Fingerprints.* One pass hashes every whole text; no text is shuffled.
2. *Directory.* The top bits of a key choose a slot of the directory, a slot
   names a bucket. It starts with one bucket; as long as a bucket holds more than
   ``CAPACITY`` keys it is split by its next bit, and the directory doubles when
   a bucket as deep as the directory must be split. Counts by prefix come from
   Spark, at most ``2**MAX_DEPTH`` of them. Keys that no further bit can part
   (equal keys, or the deepest directory) stay in an overfull bucket.
3. *Buckets* are Parquet files in the shared folder, one folder per owner, a
   range of slots and thus of keys, in key order.
4. *Chaining.* Rows whose key occurs twice or more send their text to the owner
   of the key. A map task first compares the texts of each batch, byte by byte,
   so equal ones leave it once with the list of their rows; a key with more than
   its share of rows is salted, and the heads of its chains meet in a second
   round. An owner walks its rows in key order and holds only the chain of one
   key: a row joins the first link whose bytes are equal, or opens a new link.
5. A class is (key, link). Only rows outside link 0 (real collisions of the
   64-bit hash) are written as exceptions.

Every step reads files of the shared folder, so a lost executor costs a re-read.

Defined results: a null text counts as empty, and empty texts are a class; of
equal texts the row with the smallest doc_id stays, null ids last; of rows that
repeat a doc_id and text one stays; an empty table gives no rows. Other columns
take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coact.operators.skew import FLOOR, heavy_limit, join_groups
from coact.session import default_parallelism, scratch_dir

from .common import row_key, staged

CAPACITY = 4096         # keys of a bucket
MAX_DEPTH = 20          # bits of the largest directory: 2**20 slots, 16 MB
_STEP = 7               # bits that one count by prefix looks further
_BITMAP_BITS = 1 << 26  # bits of the filter of repeated keys: 8 MB at any size
_PAGE = 1 << 15
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def normalised(text: str | None) -> bytes:
    """UTF-8 of the text with each run of ASCII white space as one space."""
    raw = text.encode() if text else b""
    words = raw.split()         # at the same six bytes
    if not words:
        return raw and b" "
    out = b" ".join(words)
    return b" " * bool(_SPACE.match(raw)) + out + b" " * bool(_SPACE.match(raw[-1:]))


def key_of(data: bytes, bits: int = 64) -> int:
    """Signed 64-bit key; fewer ``bits`` keep only its top ones (to force collisions)."""
    h = xxhash.xxh64_intdigest(data)
    if bits < 64:
        h = h >> (64 - bits) << (64 - bits)
    return h - (1 << 64) if h >> 63 else h


def fingerprints(docs: DataFrame, id_col: str, text_col: str, bits: int = 64) -> DataFrame:
    """(doc_id, rid, dk, h, sha): a number of the row, its key of id and text, the
    key and the SHA-256 of its normalised text."""
    kind = dict(docs.dtypes)[id_col]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 33
        for b in batches:
            texts = [normalised(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.arange(at, at + b.num_rows)), b.column(1),
                 pa.array([key_of(t, bits) for t in texts], pa.int64()),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                ["doc_id", "rid", "dk", "h", "sha"])
            at += b.num_rows

    own, text = F.col(id_col), F.col(text_col)
    return (docs.select(own.alias("doc_id"), row_key(own, text).alias("dk"), text.alias("text"))
            .mapInArrow(hashed, f"doc_id {kind}, rid long, dk long, h long, sha binary"))


# --- directory ---------------------------------------------------------------

def slot_of(h: Column, depth: int) -> Column:
    """The top ``depth`` bits of a key."""
    return F.shiftrightunsigned(h, 64 - depth) if depth else F.lit(0).cast("long")


class Directory:
    """Buckets (prefix, depth, number of keys) in key order, and the slots."""

    def __init__(self, buckets: list[tuple[int, int, int]], owners: int):
        self.buckets = sorted(buckets, key=lambda b: b[0] << (MAX_DEPTH - b[1]))
        self.depth = max((b[1] for b in self.buckets), default=0)
        n = np.array([b[2] for b in self.buckets], np.int64)
        # ranges of buckets with about as many keys each
        at = np.cumsum(n) - n
        owner = at * owners // max(1, int(n.sum()))
        wide = [1 << (self.depth - b[1]) for b in self.buckets]
        self.bucket_of = np.repeat(np.arange(len(self.buckets)), wide)
        self.owner_of = np.repeat(owner, wide)

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(int(k), int(b), int(o), *self.buckets[b])
                for k, (b, o) in enumerate(zip(self.bucket_of, self.owner_of))]
        return spark.createDataFrame(rows, "slot long, bucket long, owner long, prefix long, depth int, n long")


def grow_directory(keys: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH,
                   owners: int = 1) -> Directory:
    """Directory of the distinct keys ``keys`` (h)."""
    buckets, full, looked = [], [(0, 0, keys.count())], 0
    while any(n > capacity for _, _, n in full) and looked < max_depth:
        looked = min(looked + _STEP, max_depth)
        counts = np.zeros(1 + (1 << looked), np.int64)
        for r in keys.groupBy(slot_of(F.col("h"), looked).alias("p")).agg(F.count("*").alias("n")).collect():
            counts[r["p"] + 1] = r["n"]
        upto = np.cumsum(counts)
        todo, full = full, []
        while todo:
            prefix, depth, n = todo.pop()
            if n <= capacity:
                buckets.append((prefix, depth, n))
            elif depth == looked:
                full.append((prefix, depth, n))
            else:
                wide = looked - depth - 1
                for half in (2 * prefix, 2 * prefix + 1):
                    todo.append((half, depth + 1, int(upto[(half + 1) << wide] - upto[half << wide])))
    return Directory(buckets + full, owners)


class Index:
    """The index in a shared folder: ``directory`` (a row per slot) and
    ``buckets`` (h, rows, bucket), a folder per owner."""

    def __init__(self, spark: SparkSession, path: str, directory: Directory):
        self.spark, self.path, self.directory = spark, path, directory

    @classmethod
    def build(cls, entries: DataFrame, path: str, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> "Index":
        spark = entries.sparkSession
        keys = staged(entries.groupBy("h").agg(F.count("*").alias("rows")), "keys")
        directory = grow_directory(keys, capacity, max_depth, default_parallelism(spark))
        slots = directory.frame(spark)
        slots.coalesce(1).write.parquet(f"{path}/directory")
        # at most 2**MAX_DEPTH slots
        placed = (keys.withColumn("slot", slot_of(F.col("h"), directory.depth))
                  .join(F.broadcast(slots.select("slot", "bucket", "owner")), "slot").drop("slot"))
        (placed.repartition("owner").sortWithinPartitions("owner", "h")
         .write.partitionBy("owner").parquet(f"{path}/buckets"))
        return cls(spark, path, directory)

    def buckets(self) -> DataFrame:
        return self.spark.read.schema("h long, rows long, bucket long, owner long").parquet(f"{self.path}/buckets")

    def lookup(self, hashes: DataFrame) -> DataFrame:
        """(h, rows): the entries of the keys ``hashes`` (h); only the owner
        folders of their slots are read."""
        slots = self.spark.read.parquet(f"{self.path}/directory").select("slot", "owner")
        wanted = (hashes.select("h").distinct().withColumn("slot", slot_of(F.col("h"), self.directory.depth))
                  .join(F.broadcast(slots), "slot"))
        return self.buckets().join(wanted.select("h", "owner"), ["owner", "h"]).select("h", "rows")


# --- chains of equal keys ------------------------------------------------------

def _repeated_bitmap(repeated: DataFrame) -> tuple:
    """Broadcast bitmap of the low bits of the keys ``repeated`` (h). Its size is
    bounded: a crowded one lets more rows through, never fewer."""
    bits = min(_BITMAP_BITS, max(_PAGE, 1 << (16 * repeated.count()).bit_length()))
    at = F.col("h").bitwiseAND(F.lit(bits - 1))
    pages = (repeated.select((at / F.lit(_PAGE)).cast("int").alias("page"), (at % F.lit(_PAGE)).alias("at"))
             .groupBy("page").agg(F.bitmap_construct_agg("at").alias("b")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in pages:
        out[r["page"] * (_PAGE // 8):(r["page"] + 1) * (_PAGE // 8)] = np.frombuffer(r["b"], np.uint8)
    return repeated.sparkSession.sparkContext.broadcast(out), bits


_PAGES = "owner long, h long, salt int, heavy boolean, text binary, members array<long>"


def _pages(docs: DataFrame, id_col: str, text_col: str, repeated: tuple, directory: Directory,
           heavy: dict[int, int], bits: int) -> DataFrame:
    """Texts of repeated keys, one row per different text of a batch."""
    bitmap, size = repeated
    shared = docs.sparkSession.sparkContext.broadcast((directory.depth, directory.owner_of, heavy))

    def paged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        depth, owner_of, salts = shared.value
        marks, number = bitmap.value, TaskContext.get().partitionId()
        for b in batches:
            number += 1
            found: dict[bytes, list[int]] = {}
            for t, dk in zip(b.column(1).to_pylist(), b.column(0).to_pylist()):
                data = normalised(t)
                low = key_of(data, bits) & (size - 1)
                if marks[low >> 3] >> (low & 7) & 1:
                    found.setdefault(data, []).append(dk)     # the dictionary compares the bytes
            keys = [key_of(x, bits) for x in found]
            slots = [(k % (1 << 64)) >> (64 - depth) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(owner_of[s]) for s in slots], pa.int64()), pa.array(keys, pa.int64()),
                 pa.array([number % salts.get(k, 1) for k in keys], pa.int32()),
                 pa.array([k in salts for k in keys], pa.bool_()), pa.array(list(found), pa.binary()),
                 pa.array(list(found.values()), pa.list_(pa.int64()))],
                ["owner", "h", "salt", "heavy", "text", "members"])

    keyed = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("dk"), F.col(text_col).alias("text"))
    return keyed.mapInArrow(paged, _PAGES)


def _chained(rows: DataFrame, by: list[str], keep: list[str], heads: bool) -> DataFrame:
    """``keep`` with ``link`` of rows (by..., text) that lie in order of ``by``: the
    position of the row's text in the chain of its key. ``heads`` adds the text
    of the rows that open a link of a heavy key."""
    k = len(by)

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chain = None, []
        for b in batches:
            names = b.schema.names
            keys = list(zip(*(b.column(names.index(c)).to_pylist() for c in by))) if k else []
            many = b.column(names.index("heavy")).to_pylist() if heads else [False] * b.num_rows
            links, first = [], []
            for key, text, hot in zip(keys, b.column(names.index("text")).to_pylist(), many):
                if key != held:
                    held, chain = key, []
                at = next((n for n, other in enumerate(chain) if other == text), len(chain))
                new = at == len(chain)
                if new:
                    chain.append(text)
                links.append(at)
                first.append(text if new and hot else None)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(names.index(c)) for c in keep), pa.array(links, pa.int32())]
                + [pa.array(first, pa.binary())] * heads, [*keep, "link"] + ["text"] * heads)

    schema = ", ".join(f"{c} {t}" for c, t in rows.select(*keep).dtypes) + ", link int" + ", text binary" * heads
    return rows.mapInArrow(walked, schema)


def collisions(docs: DataFrame, id_col: str, text_col: str, index: Index, total: int, bits: int = 64,
               floor: int = FLOOR) -> DataFrame:
    """(dk, h, link): rows whose text is not that of link 0 of their key."""
    repeated = staged(index.buckets().where("rows > 1").select("h", "rows"), "repeated")
    limit = heavy_limit(total, floor=floor)
    # at most SHARE keys have so many rows
    heavy = {r["h"]: -(-r["rows"] // limit) for r in repeated.where(F.col("rows") > limit).collect()}
    pages = _pages(docs, id_col, text_col, _repeated_bitmap(repeated), index.directory, heavy, bits)
    dealt = pages.repartition("owner", "salt").sortWithinPartitions("h", "salt")
    chained = staged(_chained(dealt, ["h", "salt"], ["h", "salt", "heavy", "members"], True), "chained")
    heads = chained.where("text is not null").select("h", "salt", F.col("link").alias("first"), "text")
    heads = heads.repartition("h").sortWithinPartitions("h", "salt", "first")
    moved = staged(_chained(heads, ["h"], ["h", "salt", "first"], False).where("link > 0"), "moved")
    plain = chained.where("not heavy and link > 0").select("h", "link", "members")
    salted = (chained.where("heavy").select("h", "salt", F.col("link").alias("first"), "members")
              .join(moved, ["h", "salt", "first"]).select("h", "link", "members"))
    return plain.unionByName(salted).select(F.explode("members").alias("dk"), "h", "link").distinct()


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, bits: int = 64, floor: int = FLOOR) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row; the index
    stays in ``path``. ``bits`` and ``floor`` (rows that make a key heavy) are for tests."""
    spark = docs.sparkSession
    entries = staged(fingerprints(docs, id_col, text_col, bits), "fingerprints")
    index = Index.build(entries, path or scratch_dir(spark, "llm-index"), capacity, max_depth)
    total = entries.count()
    apart = staged(collisions(docs, id_col, text_col, index, total, bits, floor), "collisions")
    rows = (entries.join(apart, ["dk", "h"], "left")
            .select("doc_id", "rid", "h", F.coalesce("link", F.lit(0)).alias("link"), "sha"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
    groups = staged(rows.groupBy("h", "link").agg(F.min(order).alias("least"), F.count("*").alias("group_size"))
                    .where("group_size > 1")
                    .select("h", "link", "group_size", F.col("least.doc_id").alias("keep_id"),
                            F.col("least.rid").alias("keep_rid")), "groups")
    out = join_groups(rows, groups, ["h", "link"], "group_size", total, "left", floor=floor)
    alone = F.col("group_size").isNull()
    return out.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("rid") == F.col("keep_rid"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
