"""Token ids in files of range asymmetric numeral system (rANS) blocks.

``write_tokens`` encodes whole texts and writes a folder of three tables:

- ``ids``        the ids, a row for each batch of documents, in ascending (doc_id,
                 text hash) order, and a row with the counts of ids for each task
- ``frequency``  the static frequency table that all blocks share (id, n, f):
                 counts over the whole corpus scaled to a sum of 2**SCALE_BITS
- ``blocks``     the coded blocks in order, partitioned by ``part``, a range of
                 doc_ids; each row is one independent block

A block holds whole documents, about ``BLOCK_TOKENS`` ids, dealt to ``LANES``
interleaved 64-bit coder states, so that one step codes ``LANES`` ids at once.
Its row has the directory (doc_ids and lengths), the number of ids before it in
the corpus, the coded 32-bit words, the states and word position at every
``CHECKPOINT`` steps, from which segments can be decoded in parallel, and the
CRC-32 of each segment's ids and of the words. ``read_tokens`` decodes blocks
on any executor and verifies all checksums.

Order comes from a range partitioning by (doc_id, text hash), so rows that
share an id spread too. Numbering needs only one total per range. Parquet is
the container, so Spark's commit protocol covers lost executors, and any store
that Spark writes to will do.

Defined results: a null text is an empty one and consists of the end id; a null
doc_id sorts first; repeated rows are written each; an empty table gives files
without blocks and an empty read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import default_path, encoder

END_ID = 2
SCALE_BITS = 20
LANES = 4096
BLOCK_TOKENS = 1 << 19
CHECKPOINT = 64             # steps between saved states
LOW = np.uint64(1 << 31)    # states stay in [LOW, LOW << 32)

BLOCK_SCHEMA = ("part int, first_pos long, start long, n_ids long, doc_ids array<{kind}>, "
                "n_tokens array<int>, words binary, states binary, positions array<long>, "
                "segment_crc32 array<long>, words_crc32 long")


def scaled_frequencies(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Counts scaled to a sum of 2**bits, at least 1 for a count above 0."""
    total, size = int(counts.sum()), 1 << bits
    out = np.zeros(len(counts), np.int64)
    if not total:
        return out
    if int((counts > 0).sum()) > size:
        raise ValueError("more different ids than the frequency scale can hold")
    out[counts > 0] = np.maximum(1, counts[counts > 0].astype(float) * size // total).astype(np.int64)
    for k in np.argsort(-out, kind="stable"):       # the most frequent ids take the difference
        gap = size - int(out.sum())
        if not gap:
            break
        out[k] = max(1, out[k] + gap)
    return out


class Coder:
    """Static tables of one frequency table."""

    def __init__(self, ids: np.ndarray, freqs: np.ndarray, bits: int = SCALE_BITS):
        self.bits, self.shift = bits, np.uint64(bits)
        top = int(ids.max()) + 1 if len(ids) else 1
        f = np.zeros(top, np.uint64)
        f[ids] = freqs
        self.freq, self.base = f, np.concatenate(([0], np.cumsum(f)[:-1])).astype(np.uint64)
        self.limit = f << np.uint64(63 - bits)      # a state at or above it first gives up a word
        self.symbol = np.repeat(np.arange(top, dtype=np.uint32), f.astype(np.int64))

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray, list[int]]:
        """Words, states at each checkpoint, and their positions in the words."""
        n, lanes = len(ids), LANES
        steps = -(-n // lanes)
        x = np.full(lanes, LOW, np.uint64)
        chunks: list[np.ndarray] = []
        states, counted, total = [], [], 0
        for step in range(steps - 1, -1, -1):
            s = ids[step * lanes:(step + 1) * lanes]
            own = x[:len(s)]
            f = self.freq[s]
            full = own >= self.limit[s]
            out = own[full].astype(np.uint32)
            chunks.append(out)
            total += len(out)
            own[full] >>= np.uint64(32)
            q = own // f
            x[:len(s)] = (q << self.shift) + (own - q * f) + self.base[s]
            if step % CHECKPOINT == 0:
                states.append(x.copy())
                counted.append(total)
        words = np.concatenate(chunks[::-1]) if chunks else np.empty(0, np.uint32)
        saved = np.array(states[::-1], np.uint64).reshape(-1, lanes)
        return words.astype("<u4").tobytes(), saved, [total - c for c in counted[::-1]]

    def decode(self, words: np.ndarray, x: np.ndarray, at: int, n: int) -> np.ndarray:
        """``n`` ids from the states ``x`` on, words read from ``at``."""
        out, x, lanes = np.empty(n, np.uint32), x.copy(), LANES
        mask = np.uint64((1 << self.bits) - 1)
        for done in range(0, n, lanes):
            own = x[:min(lanes, n - done)]
            slot = own & mask
            s = self.symbol[slot]
            out[done:done + len(own)] = s
            own = self.freq[s] * (own >> self.shift) + slot - self.base[s]
            low = own < LOW
            k = int(np.count_nonzero(low))
            own[low] = (own[low] << np.uint64(32)) | words[at:at + k]
            at += k
            x[:len(own)] = own
        return out


def _segments(n: int) -> Iterator[tuple[int, int]]:
    size = LANES * CHECKPOINT
    return ((a, min(n, a + size)) for a in range(0, n, size))


def encode_block(coder: Coder, ids: np.ndarray) -> dict:
    words, states, positions = coder.encode(ids)
    raw = ids.astype("<u4")
    return {"words": words, "states": states.astype("<u8").tobytes(), "positions": positions,
            "segment_crc32": [zlib.crc32(raw[a:b].tobytes()) for a, b in _segments(len(ids))],
            "words_crc32": zlib.crc32(words)}


def decode_block(coder: Coder, block: dict) -> np.ndarray:
    """All ids of a block, segment by segment; raises on a wrong checksum."""
    if zlib.crc32(block["words"]) != block["words_crc32"]:
        raise ValueError("a block's words do not match their checksum")
    words = np.frombuffer(block["words"], "<u4").astype(np.uint64)
    states = np.frombuffer(block["states"], "<u8").reshape(-1, LANES)
    parts = []
    for k, (a, b) in enumerate(_segments(block["n_ids"])):
        ids = coder.decode(words, states[k], block["positions"][k], b - a)
        if zlib.crc32(ids.astype("<u4").tobytes()) != block["segment_crc32"][k]:
            raise ValueError("a segment's ids do not match their checksum")
        parts.append(ids)
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def _packed(ids: np.ndarray) -> bytes:
    """Ids as zstd over 16-bit numbers, or 32-bit ones after a leading 4."""
    small = not len(ids) or int(ids.max()) < 1 << 16
    raw = ids.astype("<u2" if small else "<u4").tobytes()
    return (b"2" if small else b"4") + len(raw).to_bytes(8, "little") + \
        pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[9:], int.from_bytes(data[1:9], "little"), codec="zstd", asbytes=True)
    return np.frombuffer(raw, "<u2" if data[:1] == b"2" else "<u4").astype(np.uint32)


def write_tokens(df: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every row of ``df`` into the folder ``path``."""
    spark, tokenizer = df.sparkSession, tokenizer or default_path()
    kind = dict(df.dtypes)[id_col]
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_kind = to_arrow_type(df.schema[id_col].dataType)
    end = np.array([end_id], "<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer).encode
        part, pos, before, counts = TaskContext.get().partitionId(), 0, 0, np.zeros(0, np.int64)
        fields = [pa.field(c, t) for c, t in (
            ("part", pa.int32()), ("pos", pa.int64()), ("before", pa.int64()), ("total", pa.int64()))]

        def row(total: int, doc_ids, n, ids, sums) -> pa.RecordBatch:
            arrays = [pa.array([v], f.type) for v, f in zip((part, pos, before, total), fields)]
            listed = pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids)
            return pa.RecordBatch.from_arrays(
                [*arrays, listed, pa.array([n], pa.list_(pa.int32())), pa.array([ids], pa.binary()),
                 pa.array([sums], pa.binary())],
                ["part", "pos", "before", "total", "doc_ids", "n", "ids", "counts"])

        for b in batches:
            found = [x + end for x in encode(b.column(1).to_pylist())]
            n = np.fromiter(map(len, found), np.int64, len(found)) >> 2
            ids = np.frombuffer(b"".join(found), "<u4")
            own = np.bincount(ids)
            if len(own) > len(counts):
                own, counts = counts, own.astype(np.int64)
            counts[:len(own)] += own
            yield row(len(ids), b.column(0), n, _packed(ids), None)
            pos, before = pos + len(n), before + len(ids)
        yield row(0, pa.array([], arrow_kind), np.zeros(0, np.int64), None, counts.astype("<i8").tobytes())

    text = F.col(text_col)
    rows = df.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    # texts are put in order before they are encoded: finding the ranges reads
    # the rows once more, and that must not encode them. Every later step reads the files.
    (rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
     .select("doc_id", "text")
     .mapInArrow(encoded, f"part int, pos long, before long, total long, doc_ids array<{kind}>, n array<int>, "
                          "ids binary, counts binary")
     .write.option("compression", "none").parquet(f"{path}/ids"))
    ids = spark.read.parquet(f"{path}/ids")
    _write_frequencies(ids, path)
    _write_blocks(ids, kind, path)


def _write_frequencies(ids: DataFrame, path: str) -> None:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(0, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                own = np.frombuffer(x, "<i8")
                if len(own) > len(sums):
                    own, sums = sums, own.copy()
                sums[:len(own)] += own
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["id", "n"])

    # at most as many rows as the tokenizer has ids
    rows = (ids.where("counts is not null").select("counts").mapInArrow(counted, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").collect())
    freqs = scaled_frequencies(np.array([r["n"] for r in rows], np.int64))
    (ids.sparkSession.createDataFrame([(r["id"], r["n"], int(f)) for r, f in zip(rows, freqs)],
                                      "id long, n long, f long")
     .coalesce(1).write.parquet(f"{path}/frequency"))


def _coder(spark: SparkSession, path: str):
    rows = spark.read.parquet(f"{path}/frequency").select("id", "f").collect()
    table = (np.array([r["id"] for r in rows], np.int64), np.array([r["f"] for r in rows], np.uint64))
    return spark.sparkContext.broadcast(table)


def _write_blocks(ids: DataFrame, kind: str, path: str) -> None:
    spark = ids.sparkSession
    # a row for each range: ids in it, summed up in order
    sizes = {r["part"]: r["n"] for r in ids.groupBy("part").agg(F.sum("total").alias("n")).collect()}
    starts, total = {}, 0
    for part in sorted(sizes):
        starts[part] = total
        total += sizes[part]
    table = _coder(spark, path)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*table.value)
        held: list[tuple] = []
        size = 0

        def flushed() -> pa.RecordBatch:
            out = encode_block(coder, np.concatenate([h[5] for h in held]))
            row = {"part": held[0][0], "first_pos": held[0][1], "start": starts[held[0][0]] + held[0][2],
                   "n_ids": size, "doc_ids": [x for h in held for x in h[3]],
                   "n_tokens": [x for h in held for x in h[4]], **out}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        def runs(b: pa.RecordBatch) -> Iterator[tuple]:
            """(part, pos, before, doc_ids, n, ids): whole documents of a batch, about a block at most."""
            for part, pos, before, doc_ids, n, data in zip(*(c.to_pylist() for c in b.columns)):
                ids, ends = _unpacked(data), np.cumsum(n)
                k = at = 0
                while k < len(n):
                    upto = max(k + 1, int(np.searchsorted(ends, at + BLOCK_TOKENS, "right")))
                    yield part, pos + k, before + at, doc_ids[k:upto], n[k:upto], ids[at:ends[upto - 1]]
                    k, at = upto, int(ends[upto - 1])

        for b in batches:
            for r in runs(b):
                # a block never spans ranges or a gap, as where a file was split
                if held and (size >= BLOCK_TOKENS or r[0] != held[0][0] or r[1] != held[-1][1] + len(held[-1][3])):
                    yield flushed()
                    held, size = [], 0
                held.append(r)
                size += len(r[5])
        if held:
            yield flushed()

    declared = BLOCK_SCHEMA.format(kind=kind)
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(spark.createDataFrame([], declared).schema)
    (ids.where("ids is not null").select("part", "pos", "before", "doc_ids", "n", "ids").mapInArrow(blocks, declared)
     .write.partitionBy("part").option("compression", "none").parquet(f"{path}/blocks"))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files;
    ``with_ids`` adds the ids themselves. The type of doc_id is that of ``ids``."""
    kind = spark.read.parquet(f"{path}/ids").schema["doc_ids"].dataType.elementType.simpleString()
    declared = BLOCK_SCHEMA.format(kind=kind)
    blocks = spark.read.schema(declared).parquet(f"{path}/blocks")
    table = _coder(spark, path)
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*table.value)
        for b in batches:
            for k in range(b.num_rows):
                block = {c: b.column(c)[k].as_py() for c in b.schema.names if c != "doc_ids"}
                ids = decode_block(coder, block)
                n = np.array(block["n_tokens"], np.int64)
                upto = np.cumsum(n)
                raw = ids.astype("<u4")
                each = [raw[e - m:e] for e, m in zip(upto, n)]
                arrays = [b.column("doc_ids")[k].values, pa.array(block["start"] + upto - n), pa.array(n),
                          pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64())]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int64) for x in each], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, names)

    return blocks.mapInArrow(
        read, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
