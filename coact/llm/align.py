"""Cross-tokenizer alignment with corpus-wide counts by minimal perfect hashing.

A text is encoded by two tokenizers: space + text by a byte-level BPE file of the
``tokenizers`` library (A), the text by a ``sentencepiece`` model that adds the
space itself (B). Both give byte ranges over the same bytes; offsets where tokens
of both end cut them into groups, and the A and B tokens that end there together
are linked.

1. *Align.* One pass encodes every whole text, checks that both sides' bytes are
   the text's, and writes the ids of both sides (16 or 32 bits) and the digest of
   the groups. Later passes align anew from the ids; no text is encoded twice.
2. *Hash.* The distinct pairs are dealt to shards of about ``SHARD`` keys by hash.
   Each shard is one group that builds a minimal perfect hash function: keys set
   bits of a table, keys that meet go on to the next table, and the rank of a
   key's bit among all bits is its number. Shards follow each other, so the
   numbers run from 0 to the number of pairs.
3. *Count.* Every task re-aligns its documents from the ids and counts links in a
   dense vector indexed by the hash; vectors are cut into pages, and the pages
   are summed in a tree of fan-in ``FAN``.
4. *Look up.* A second pass re-aligns the documents, finds each link's number, and
   verifies that the key stored there is the pair itself.

Hash, keys and counts are broadcast in slices of at most ``SLICE`` pairs, so their
size has a bound; more pairs take a pass over the ids for each slice, and nothing
else changes. The highest count of each B id has at most as many rows as B's
vocabulary.

Defined results: texts that are null, empty, or whose joined bytes on either side
differ from space + text have no tokens: zeros, and '' for the digest; repeated
rows are documents of their own and all count; an empty table gives no rows.
Strings of special tokens inside a text are plain text. Other columns take no
part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coact.session import scratch_dir

from .common import hold, staged
from .tokens import CHUNK_CHARS, encoder, gather, simple

SHARD = 1 << 15             # keys of one shard of the hash function, about
SLICE = 1 << 22             # pairs that are broadcast at a time: 64 MB of keys and counts
PAGE = 1 << 15              # counts of one page
FAN = 64                    # partial vectors that one task sums
FLUSH = 1 << 20             # different pairs that a task holds before it hands them on
_GAMMA = 1.5                # bits of a table for each key that is left
_SPACE = "\u2581"          # that stands for a space in the pieces of B
_U = np.uint64
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# --- tokens and their bytes ------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    ones stand for themselves, the others follow from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    return letters | {chr(256 + k): b for k, b in enumerate(rest)}


class Side:
    """The bytes of every id of a tokenizer."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.lengths = np.array(list(map(len, tokens)), np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.starts[ids], self.lengths[ids])


class Pair:
    """Both tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = encoder(path_a)
        letters, special = _byte_letters(), self.a.tokenizer.get_added_tokens_decoder()
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = token.encode() if i in special else bytes(letters[c] for c in token)
        self.side_a = Side(tokens)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.side_b = Side([bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(_SPACE, " ").encode()
                            for k, p in enumerate(map(self.b.id_to_piece, range(self.b.vocab_size())))])
        self.space_b = self.b.piece_to_id(_SPACE)
        # the model's pieces have its space sign in front only, so words of a text stand alone
        self.by_words = not any(_SPACE in p.lstrip(_SPACE) for p in map(self.b.id_to_piece, range(self.b.vocab_size())))
        # ids with the mark in front of them: none, between ids, between the sides, between groups
        self.size = max(len(tokens), self.b.vocab_size())
        self.names = [mark + str(k) for mark in ("", ",", "|", ";") for k in range(self.size)]

    def written(self, a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray, first: np.ndarray) -> list[str]:
        """The strings of ``a1,a2|b1;a3|b2,b3`` by id: groups end at the positions
        ``p`` of A and ``q`` of B; those numbered ``first`` open a text."""
        n_a, n_b = np.diff(np.r_[-1, p]), np.diff(np.r_[-1, q])
        mark_a, mark_b = np.ones(len(a), np.int64), np.ones(len(b), np.int64)
        mark_a[p + 1 - n_a] = 3
        mark_a[(p + 1 - n_a)[first[first < len(p)]]] = 0
        mark_b[q + 1 - n_b] = 2
        # a group's ids of A, then those of B
        before = np.cumsum(n_b) - n_b
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + np.repeat(before, n_a)] = a + mark_a * self.size
        out[np.arange(len(b)) + np.repeat(np.cumsum(n_a), n_b)] = b + mark_b * self.size
        return list(map(self.names.__getitem__, out.tolist()))

    def clear(self) -> None:
        self.a.clear()

    def whole(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides of texts that are not empty; empty arrays where a
        side's bytes are not the text's."""
        none = np.zeros(0, np.int64)
        out = []
        found_b = self.b.encode(texts, num_threads=1) if texts else []
        for t, x, y in zip(texts, self.a.encode([" " + t for t in texts]), found_b):
            a, b, want = np.frombuffer(x, "<u4").astype(np.int64), np.array(y, np.int64), (" " + t).encode()
            good = self.side_a.bytes_of(a).tobytes() == want == self.side_b.bytes_of(b).tobytes()
            out.append((a, b) if good else (none, none))
        return out


class Words:
    """Both sides' ids and the groups of different words, each after a space."""

    def __init__(self, both: Pair, column: pa.Array):
        names = column.to_numpy(zero_copy_only=False).tolist()
        found_a, found_b = both.a.ids_of(column), both.b.encode(names, num_threads=1)
        if "" in names:
            found_b[names.index("")] = [both.space_b]
        wide = pc.binary_length(column).to_numpy().astype(np.int64) + 1
        want = np.frombuffer((" " + " ".join(names)).encode(), np.uint8)
        self.good = np.ones(len(names), bool)
        self._set(found_a, found_b)
        len_a, len_b = both.side_a.lengths[self.a], both.side_b.lengths[self.b]
        if not (len_a.all() and len_b.all() and np.array_equal(_sums(len_a, self.n_a), wide)
                and np.array_equal(_sums(len_b, self.n_b), wide)
                and np.array_equal(both.side_a.bytes_of(self.a), want)
                and np.array_equal(both.side_b.bytes_of(self.b), want)):
            # words that differ, or have a token without bytes, are left to the whole texts
            for k, (n, x, y) in enumerate(zip(names, found_a, found_b)):
                x, own = np.frombuffer(x, "<u4"), (" " + n).encode()
                self.good[k] = (both.side_a.bytes_of(x).tobytes() == own == both.side_b.bytes_of(y).tobytes()
                                and both.side_a.lengths[x].all() and both.side_b.lengths[y].all())
                if not self.good[k]:
                    found_a[k], found_b[k], wide[k] = b"", [], 0
            self._set(found_a, found_b)
            len_a, len_b = both.side_a.lengths[self.a], both.side_b.lengths[self.b]
        cuts, p, q = align(np.cumsum(len_a), np.cumsum(len_b))
        self.n_groups = np.diff(np.r_[0, np.searchsorted(cuts, np.cumsum(wide), "right")])
        parts = both.written(self.a, self.b, p, q, np.cumsum(self.n_groups) - self.n_groups)
        upto = np.cumsum(self.n_a + self.n_b).tolist()
        self.text = ["".join(parts[m:n]) for m, n in zip([0, *upto[:-1]], upto)]

    def _set(self, a: list[bytes], b: list[list[int]]) -> None:
        self.n_a = np.fromiter(map(len, a), np.int64, len(a)) >> 2
        self.n_b = np.fromiter(map(len, b), np.int64, len(b))
        self.a = np.frombuffer(b"".join(a), "<u4").astype(np.int64)
        self.b = np.fromiter(chain.from_iterable(b), np.int64, int(self.n_b.sum()))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    upto = np.cumsum(sizes)
    return total[upto] - total[upto - sizes]


_pairs: dict[tuple[str, str], Pair] = {}


def _both(paths: tuple[str, str]) -> Pair:
    if paths not in _pairs:
        _pairs[paths] = Pair(*paths)
    hold(_pairs[paths])
    return _pairs[paths]


# --- alignment --------------------------------------------------------------------------

def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common ends, and the links (positions of A, positions of B): all pairs of
    tokens that end together. Tokens without bytes share an end with others."""
    if not len(ends_a) or not len(ends_b):
        return (np.zeros(0, np.int64),) * 3
    if (np.diff(ends_a) > 0).all() and (np.diff(ends_b) > 0).all():
        marks = np.zeros((2, max(ends_a[-1], ends_b[-1]) + 1), bool)
        marks[0, ends_a] = marks[1, ends_b] = True
        p, q = np.flatnonzero(marks[1, ends_a]), np.flatnonzero(marks[0, ends_b])
        return ends_a[p], p, q
    cuts = np.intersect1d(ends_a, ends_b)
    lo_a, hi_a = np.searchsorted(ends_a, cuts), np.searchsorted(ends_a, cuts, "right")
    lo_b, hi_b = np.searchsorted(ends_b, cuts), np.searchsorted(ends_b, cuts, "right")
    n_a, n_b = hi_a - lo_a, hi_b - lo_b
    n = n_a * n_b
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    wide = np.repeat(n_b, n)
    return cuts, np.repeat(lo_a, n) + k // wide, np.repeat(lo_b, n) + k % wide


def _aligned(both: Pair, texts: list[str | None]) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, digest, ids of A, ids of B) of each text.
    Words of texts whose white space stands alone are aligned once for all."""
    none = np.zeros(0, np.int64)
    out = [(0, 0, 0, 0, "", _stored(none), _stored(none))] * len(texts)
    at = [k for k, t in enumerate(texts) if t]
    column = pa.array([texts[k] for k in at], pa.string())
    alone = simple(pa.array([" " + texts[k] for k in at], pa.string())) & both.by_words
    alone &= ~pc.match_substring(column, _SPACE).to_numpy(zero_copy_only=False).astype(bool)
    places = np.flatnonzero(alone)
    if len(places):
        split = pc.split_pattern(column.take(pa.array(places)), " ")
        coded = split.flatten().dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words, n = Words(both, coded.dictionary), np.diff(split.offsets.to_numpy())
        bad = _sums(~words.good[which], n) > 0
        n_a, n_b, n_groups = (_sums(x[which], n).tolist() for x in (words.n_a, words.n_b, words.n_groups))
        a, b = (gather(x, (np.cumsum(m) - m)[which], m[which])
                for x, m in ((words.a, words.n_a), (words.b, words.n_b)))
        order, p, q, w = which.tolist(), 0, 0, 0
        for d, k in enumerate(places.tolist()):
            if not bad[d]:
                text = ";".join(map(words.text.__getitem__, order[w:w + n[d]]))
                out[at[k]] = (n_a[d], n_b[d], n_groups[d], n_groups[d], hashlib.sha256(text.encode()).hexdigest(),
                              _stored(a[p:p + n_a[d]]), _stored(b[q:q + n_b[d]]))
            p, q, w = p + n_a[d], q + n_b[d], w + n[d]
        alone[places[bad]] = False
    rest = [at[k] for k in np.flatnonzero(~alone)]
    for k, (x, y) in zip(rest, both.whole([texts[k] for k in rest])):
        if len(x):
            ends_x, ends_y = np.cumsum(both.side_a.lengths[x]), np.cumsum(both.side_b.lengths[y])
            cuts, links, _ = align(ends_x, ends_y)
            last = (np.searchsorted(e, cuts, "right") - 1 for e in (ends_x, ends_y))
            text = "".join(both.written(x, y, *last, np.zeros(1, np.int64)))
            out[k] = (len(x), len(y), len(cuts), len(links), hashlib.sha256(text.encode()).hexdigest(),
                      _stored(x), _stored(y))
    return out


def _codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a << 32 | b


def _stored(ids: np.ndarray) -> bytes:
    small = not len(ids) or int(ids.max()) < 1 << 16
    return (b"2" if small else b"4") + ids.astype("<u2" if small else "<u4").tobytes()


def _loaded(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2" if data[:1] == b"2" else "<u4", offset=1)


_DOC = "doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a binary, b binary"


def align_documents(docs: DataFrame, path: str, paths: tuple[str, str], id_col: str, text_col: str) -> None:
    """Write ``documents``, a row for each."""
    kind = dict(docs.dtypes)[id_col]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _both(paths)
        for b in batches:
            rows: list[tuple] = []
            chunk: list = []
            size = 0
            for t in b.column(1).to_pylist():
                chunk.append(t)
                size += len(t or "")
                if size > CHUNK_CHARS:
                    rows += _aligned(both, chunk)
                    chunk, size = [], 0
            cols = list(zip(*(rows + _aligned(both, chunk)))) or [()] * 7
            types = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *map(pa.array, cols, types)],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b"])

    (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
     .mapInArrow(aligned, _DOC.format(kind=kind))
     .write.option("compression", "zstd").parquet(f"{path}/documents"))


def _joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64), sizes


def _links(a: pa.Array, b: pa.Array, lengths: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The pair codes of the links of all documents in turn, aligned anew from the
    ids, and the number of links of each document."""
    (x, n), (y, m) = (_joined([_loaded(v) for v in c.to_pylist()]) for c in (a, b))
    docs = np.arange(len(n))
    # both sides of a document have the same bytes; one more parts it from the next
    doc_x, doc_y = np.repeat(docs, n), np.repeat(docs, m)
    _, p, q = align(np.cumsum(lengths[0][x]) + doc_x, np.cumsum(lengths[1][y]) + doc_y)
    return _codes(x[p], y[q]), np.bincount(doc_x[p], minlength=len(n))


# --- minimal perfect hashing ----------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def _salt(level: int) -> np.uint64:
    return _U((level + 1) * _STEP % (1 << 64))


def shard_of(codes: np.ndarray, shards: int) -> np.ndarray:
    return (mix(codes.astype(np.uint64) ^ _M2) % _U(shards)).astype(np.int64)


def build_hash(keys: np.ndarray, gamma: float = _GAMMA) -> list[tuple[int, np.ndarray]]:
    """Tables (size, sorted positions of its bits) of distinct 64-bit keys."""
    left, levels = keys.astype(np.uint64), []
    while len(left):
        size = max(1, int(np.ceil(gamma * len(left))))
        at = (mix(left + _salt(len(levels))) % _U(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size)[at] == 1
        levels.append((size, np.sort(at[alone])))
        left = left[~alone]
    return levels


def find_hash(levels: list[tuple[int, np.ndarray]], keys: np.ndarray) -> np.ndarray:
    """Numbers of ``keys``, -1 for a key that meets no bit (others may be wrong:
    verify)."""
    out = np.full(len(keys), -1, np.int64)
    todo, before = np.arange(len(keys)), 0
    left = keys.astype(np.uint64)
    for k, (size, bits) in enumerate(levels):
        at = (mix(left + _salt(k)) % _U(size)).astype(np.int64)
        rank = np.minimum(np.searchsorted(bits, at), max(len(bits) - 1, 0))
        hit = bits[rank] == at if len(bits) else np.zeros(len(at), bool)
        out[todo[hit]] = before + rank[hit]
        todo, left = todo[~hit], left[~hit]
        before += len(bits)
        if not len(todo):
            break
    return out


class HashSlice:
    """The hash function of some shards, with the key at each number."""

    def __init__(self, shards: int, tables: dict[int, list[tuple[int, np.ndarray]]], offsets: dict[int, int],
                 keys: np.ndarray):
        self.shards, self.tables, self.offsets, self.keys = shards, tables, offsets, keys

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Numbers of pair codes within the slice, -1 for others; verified."""
        out = np.full(len(codes), -1, np.int64)
        shard = shard_of(codes, self.shards)
        order = np.argsort(shard, kind="stable")
        bound = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0, True]) if len(codes) else [0]
        for lo, hi in zip(bound[:-1], bound[1:]):
            s = int(shard[order[lo]])
            if s in self.tables:
                part = order[lo:hi]
                n = find_hash(self.tables[s], codes[part])
                out[part] = np.where(n >= 0, n + self.offsets[s], -1)
        good = out >= 0
        out[good] = np.where(self.keys[out[good]] == codes[good], out[good], -1)
        return out


def write_hash(spark: SparkSession, path: str, lengths) -> int:
    """``hash``: a row per shard (shard, n, keys in the order of their numbers);
    returns the number of shards."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for b in batches:
            held.append(pd.unique(_links(b.column(0), b.column(1), lengths.value)[0]))
            size += len(held[-1])
            if size > FLUSH:
                held = [np.unique(np.concatenate(held))]
                size = len(held[0])
                if size > FLUSH // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0])], ["pair"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)))], ["pair"])

    docs = spark.read.parquet(f"{path}/documents")
    pairs = staged(docs.select("a", "b").mapInArrow(distinct, "pair long").distinct(), "pairs")
    shards = max(1, -(-pairs.count() // SHARD))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard_of(b.column(0).to_numpy(), shards)), b.column(0)], ["shard", "pair"])

    def built(table: pa.Table) -> pa.Table:
        keys = np.unique(table.column("pair").to_numpy())
        order = np.empty_like(keys)
        order[find_hash(build_hash(keys), keys)] = keys
        return pa.table({"shard": table.column("shard")[:1], "n": pa.array([len(keys)], pa.int64()),
                         "keys": pa.array([order.astype("<i8").tobytes()], pa.binary())})

    (pairs.mapInArrow(numbered, "shard long, pair long").groupBy("shard")
     .applyInArrow(built, "shard long, n long, keys binary")
     .write.option("compression", "zstd").parquet(f"{path}/hash"))
    return shards


def read_slices(spark: SparkSession, path: str, shards: int, most: int) -> list[tuple[int, int]]:
    """First and last shard of each slice of at most ``most`` pairs (a shard is
    never cut)."""
    out: list[tuple[int, int]] = []
    size = 0
    for r in spark.read.parquet(f"{path}/hash").select("shard", "n").orderBy("shard").toLocalIterator():
        if out and size + r["n"] <= most:
            out[-1] = (out[-1][0], r["shard"])
            size += r["n"]
        else:
            out.append((r["shard"], r["shard"]))
            size = r["n"]
    return out


def load_slice(spark: SparkSession, path: str, shards: int, part: tuple[int, int]) -> HashSlice:
    tables, offsets, keys, at = {}, {}, [], 0
    rows = spark.read.parquet(f"{path}/hash").where(F.col("shard").between(*part)).orderBy("shard")
    for r in rows.toLocalIterator():
        own = np.frombuffer(r["keys"], "<i8")
        tables[r["shard"]], offsets[r["shard"]] = build_hash(own), at
        keys.append(own)
        at += len(own)
    return HashSlice(shards, tables, offsets, np.concatenate(keys))


# --- counts ------------------------------------------------------------------------------------

def count_links(docs: DataFrame, shared, lengths) -> DataFrame:
    """(node, page, counts): dense counts by the numbers of a slice, summed in a
    tree and cut into pages; pages of zeros are left out."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = shared.value
        sums = np.zeros(len(own.keys), np.int64)
        for b in batches:
            which, codes = pd.factorize(_links(b.column(0), b.column(1), lengths.value)[0])
            at, n = own.find(codes), np.bincount(which, minlength=len(codes))
            sums[at[at >= 0]] += n[at >= 0]
        node = TaskContext.get().partitionId()
        for page, p0 in enumerate(range(0, len(sums), PAGE)):
            part = sums[p0:p0 + PAGE]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node], pa.int64()), pa.array([page], pa.int64()),
                     pa.array([part.astype("<i8").tobytes()], pa.binary())], ["node", "page", "counts"])

    def summed(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), "<i8") for x in table.column("counts"))
        return pa.table({"node": pa.array([table.column("node")[0].as_py() // FAN], pa.int64()),
                         "page": table.column("page")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "node long, page long, counts binary"
    pages = staged(docs.select("a", "b").mapInArrow(counted, schema), "pages")
    while True:
        nodes = pages.agg(F.max("node")).first()[0] or 0
        pages = staged(pages.groupBy(F.floor(F.col("node") / FAN).alias("up"), "page")
                       .applyInArrow(summed, schema), "pages")
        if nodes < FAN:
            return pages


def _dense(pages: DataFrame, n: int) -> np.ndarray:
    """The counts of a slice, at most ``SLICE`` of them."""
    out = np.zeros(n, np.int64)
    for r in pages.toLocalIterator():
        part = np.frombuffer(r["counts"], "<i8")
        out[r["page"] * PAGE:r["page"] * PAGE + len(part)] = part
    return out


def _look_up(docs: DataFrame, shared, lengths) -> DataFrame:
    """Adds the links of a slice to ``n_best`` and ``count_sum``."""
    def looked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts, best = shared.value
        for b in batches:
            col = dict(zip(b.schema.names, b.columns))
            links, size = _links(col["a"], col["b"], lengths.value)
            back, codes = pd.factorize(links)
            at = own.find(codes)
            n = np.where(at >= 0, counts[at], 0)
            top = (at >= 0) & (n == best[codes & 0xFFFFFFFF])
            new = {"n_best": pa.array(col["n_best"].to_numpy() + _sums(top[back], size)),
                   "count_sum": pa.array(col["count_sum"].to_numpy() + _sums(n[back], size))}
            yield pa.RecordBatch.from_arrays([new.get(c, x) for c, x in col.items()], list(col))

    return docs.mapInArrow(looked, docs.schema)


def align_corpus(docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id",
                 text_col: str = "text", path: str | None = None, most: int = SLICE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of
    every row. ``path`` keeps ``documents`` (with the ids of both sides) and
    ``hash``."""
    spark, paths = docs.sparkSession, paths or default_paths()
    path = path or scratch_dir(spark, "llm-align")
    align_documents(docs, path, paths, id_col, text_col)
    both = Pair(*paths)
    sc = spark.sparkContext
    lengths = sc.broadcast((both.side_a.lengths, both.side_b.lengths))          # vocabulary sizes
    shards = write_hash(spark, path, lengths)
    found = spark.read.parquet(f"{path}/documents")
    best = np.zeros(len(both.side_b.lengths), np.int64)                    # of B's vocabulary
    slices = read_slices(spark, path, shards, most)
    summed = []
    for part in slices:
        piece = load_slice(spark, path, shards, part)
        pages = count_links(found, sc.broadcast(piece), lengths)
        np.maximum.at(best, piece.keys & 0xFFFFFFFF, _dense(pages, len(piece.keys)))
        summed.append(pages)
    out = found.withColumn("n_best", F.lit(0).cast("long")).withColumn("count_sum", F.lit(0).cast("long"))
    for k, (part, pages) in enumerate(zip(slices, summed)):
        if k:
            out = staged(out, "looked")         # a task holds one slice at a time
        piece = load_slice(spark, path, shards, part)
        out = _look_up(out, sc.broadcast((piece, _dense(pages, len(piece.keys)), best)), lengths)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
