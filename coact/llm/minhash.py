"""Near-duplicate classes by DartMinHash signatures and a banded join.

Every distinct shingle (five words, lower case) is a region of weight 1 (or its
count). Darts fall into an element's region at the arrival times of a Poisson
process seeded by the element alone, so equal elements receive the same darts
in every document. Each dart has a coordinate; the earliest dart of each of the
``COORDINATES`` coordinates makes the signature, and two signatures agree in a
coordinate with probability equal to the weighted Jaccard similarity. Only the
darts up to a time that fills the coordinates are ever thrown, about
``k (ln k + 3)`` for any length of text.

``BANDS`` bands of ``BAND_ROWS`` coordinates are the join keys: a pair at
similarity 0.8 misses all of them with probability (1 - 0.8**4)**24 < 4e-6.

1. Rows with equal shingle sets are one *node* (exact copies meet here and are
   counted before anything is exchanged by key).
2. The shingles that only one of the nodes in shared buckets has bound its
   similarity to every other: a node with more than a fifth of such shingles
   has no partner and leaves, and pairs are bound in the same way.
3. In every bucket the members are paired with the bucket's least node only,
   and the pairs are verified exactly on the shingle sets.
4. Connected components of the verified links collapse each group. Members of
   one bucket that are still in different components are then paired with each
   other, unless the bounds or their similarities to the bucket's least node
   (triangle inequality) rule a link out: block by block inside the bucket, so
   that only links leave the tasks that compare. So every pair that
   shares a bucket is either in one class already, or compared, or provably
   dissimilar; no group is expanded into all its pairs.
5. Components of all links are the classes.

What is broadcast is a bitmap of bounded size; no links, classes or keys are
collected.

Defined results: texts of one to four words have one shingle, all their words;
a null text or one without words is a class of its own row; the class id is the
smallest doc_id in the class (null ids only form a class with a null id when
nothing else is in it); repeated rows fall in one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hold, row_key, staged, words_of

SHINGLE = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 24, 4
COORDINATES = BANDS * BAND_ROWS

_U = np.uint64
_GOLD, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_POWERS = np.array([pow(0x100000001B3, k, 1 << 64) for k in range(64)], np.uint64)

_CACHE_WORDS = 300_000
_cache: dict[str, int] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def _word_hash(word: str) -> int:
    got = _cache.get(word)
    if got is None:
        if len(_cache) >= _CACHE_WORDS:
            _cache.clear()
        got = _cache[word] = xxhash.xxh64_intdigest(word.encode())
    return got


def shingles(text: str | None, size: int = SHINGLE, counts: bool = False):
    """Sorted distinct 64-bit shingles of a whole text (with their counts)."""
    words = words_of(text.lower()) if text else []
    n = len(words)
    h = np.fromiter(map(_word_hash, words), np.uint64, n)
    if n > size:
        rolled = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            rolled += h[k:n - size + 1 + k] * _POWERS[k]
        h = rolled
    elif n:
        h = (h * _POWERS[:n]).sum(keepdims=True, dtype=np.uint64) + _U(n if n < size else 0)
    return np.unique(mix(h), return_counts=counts)


def dart_signature(elements: np.ndarray, weights: np.ndarray | None = None,
                   k: int = COORDINATES) -> np.ndarray:
    """The earliest dart (a 64-bit name) of each coordinate."""
    if weights is None:
        strips, limits = elements, None
        total = float(len(elements))
    else:
        # a region of weight w is ceil(w) strips of the weight axis, the last cut at w
        n = np.ceil(weights).astype(np.int64)
        first = np.repeat(np.cumsum(n) - n, n)
        strip = (np.arange(n.sum()) - first).astype(np.uint64)
        strips = mix(np.repeat(elements, n) + strip * _M2)
        limits = np.minimum(1.0, np.repeat(weights, n) - strip)
        total = float(weights.sum())
    until = k * (np.log(k) + 3) / total
    while True:
        times, names = _darts(strips, limits, until)
        where = (mix(names + _GOLD) % _U(k)).astype(np.int64)
        latest_first = np.argsort(-times, kind="stable")
        out = np.zeros(k, np.uint64)
        filled = np.zeros(k, bool)
        out[where[latest_first]] = names[latest_first]     # the earliest is written last
        filled[where] = True
        if filled.all():
            return out
        until *= 2


def _darts(strips: np.ndarray, limits: np.ndarray | None, until: float) -> tuple[np.ndarray, np.ndarray]:
    """Arrival times and names of all darts before ``until``."""
    live = np.arange(len(strips))
    now = np.zeros(len(strips))
    times, names, thrown = [], [], 0
    step = max(1, int(until + 3 * np.sqrt(until))) if until >= 1 else 1
    while len(live):
        number = np.arange(thrown, thrown + step, dtype=np.uint64) * _GOLD
        name = mix(strips[live][:, None] + number[None, :])
        gap = -np.log(((mix(name ^ _M1) >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
        at = now[live][:, None] + np.cumsum(gap, axis=1)
        hit = at < until
        if limits is not None:
            depth = (mix(name ^ _M2) >> _U(11)).astype(np.float64) * 2.0 ** -53
            inside = hit & (depth < limits[live][:, None])
        else:
            inside = hit
        times.append(at[inside])
        names.append(name[inside])
        now[live] = at[:, -1]
        live = live[hit[:, -1]]
        thrown += step
    return np.concatenate(times), np.concatenate(names)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = signature.reshape(bands, -1)
    key = np.arange(bands, dtype=np.uint64) * _GOLD
    for k in range(rows.shape[1]):
        key = mix(key + rows[:, k])
    return key.view(np.int64)


def signature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    weighted: bool = False) -> DataFrame:
    """(doc_id, dk, v, keys) of every row: row key, node (null without words),
    band keys."""
    kind = dict(docs.dtypes)[id_col]

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(_cache)
        for b in batches:
            nodes, keys = [], []
            for t in b.column(2).to_pylist():
                s, n = shingles(t, counts=True)
                if not len(s):
                    nodes.append(None)
                    keys.append(None)
                    continue
                w = n.astype(float) if weighted else None
                name = s if w is None else mix(s + n.astype(np.uint64) * _M2)
                nodes.append(xxhash.xxh64_intdigest(name.tobytes()) - (1 << 63))
                keys.append(band_keys(dart_signature(s, w)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(nodes, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "dk", "v", "keys"])

    own, text = F.col(id_col), F.col(text_col)
    return (docs.select(own.alias("doc_id"), row_key(own, text).alias("dk"), text.alias("text"))
            .mapInArrow(signed, f"doc_id {kind}, dk long, v long, keys array<long>"))


_MARK = 6      # bytes of a shingle in the sets that are compared


_PAGE = 1 << 15           # bits of one bitmap row
_MOST_BITS = 1 << 26      # bits of the whole bitmap: 8 MB at any size of the corpus


def key_bitmap(keys: DataFrame):
    """Broadcast bitmap of the hashed ``dk`` of a table; of bounded size, so a
    crowded one lets more rows through but never fewer."""
    bits = min(_MOST_BITS, max(_PAGE, 1 << (16 * keys.count()).bit_length()))
    at = F.pmod(F.xxhash64(F.lit("bit"), "dk"), F.lit(bits))
    pages = (keys.select((at / F.lit(_PAGE)).cast("int").alias("page"), (at % F.lit(_PAGE)).alias("at"))
             .groupBy("page").agg(F.bitmap_construct_agg("at").alias("b")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in pages:
        out[r["page"] * (_PAGE // 8):(r["page"] + 1) * (_PAGE // 8)] = np.frombuffer(r["b"], np.uint8)
    return keys.sparkSession.sparkContext.broadcast(out), bits


def shingle_sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(v, n, s): the shingle set of each node in ``nodes`` (v, dk), as sorted
    48-bit numbers, and its size; one row per node. Only rows whose key may be
    wanted are shingled, and only their sets are shuffled, no text."""
    shared, bits = key_bitmap(nodes)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(_cache)
        bitmap = shared.value
        for b in batches:
            at = b.column(1).to_numpy()
            b = b.filter(pa.array((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            sets = []
            for t in b.column(2).to_pylist():
                s = np.unique(shingles(t) >> _U(16))
                sets.append(s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_MARK].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) // _MARK for s in sets], pa.int32()),
                 pa.array(sets, pa.binary())], ["dk", "n", "s"])

    keyed = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("dk"), F.col(text_col).alias("text"))
    sets = (keyed.select("dk", F.pmod(F.xxhash64(F.lit("bit"), "dk"), F.lit(bits)).alias("at"), "text")
            .mapInArrow(listed, "dk long, n int, s binary"))
    return sets.join(nodes.select("v", "dk"), "dk").select("v", "n", "s").dropDuplicates(["v"])


def own_shingles(sets: DataFrame) -> DataFrame:
    """(v, u): how many of a node's shingles no other node of ``sets`` has."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                raw = part.column(1).to_pylist()
                if raw:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_numbers(b"".join(raw)).astype(np.int64)),
                         pa.array(np.repeat(part.column(0).to_numpy(), [len(x) // _MARK for x in raw]))], ["x", "v"])

    return (sets.select("v", "s").mapInArrow(each, "x long, v long")
            .groupBy("x").agg(F.min("v").alias("v"), F.max("v").alias("w")).where("v = w")
            .groupBy("v").agg(F.count("*").cast("int").alias("u")))


def _numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, _MARK)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :_MARK] = raw
    return out.view("<u8").ravel()


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, j): the exact Jaccard similarity of each pair of nodes."""
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                p, q = _numbers(x), _numbers(y)
                both = len(np.intersect1d(p, q, assume_unique=True))
                out.append(both / (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.float64())], ["a", "b", "j"])

    left = sets.select(F.col("v").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("v").alias("b"), F.col("s").alias("sb"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
            .mapInArrow(compared, "a long, b long, j double"))


def components(links: DataFrame) -> DataFrame:
    """(v, c): every node of ``links`` (a, b) with the least node of its
    component, by alternating large and small stars."""
    e = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .where("u != v").distinct(), "links")
    seen = None
    while True:
        state = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        large = staged(large, "large")
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = staged(small.unionByName(root.select("u", F.col("m").alias("v"))).distinct(), "small")
    roots = e.select(F.col("v")).distinct()
    return e.select(F.col("u").alias("v"), F.col("v").alias("c")).unionByName(
        roots.select("v", F.col("v").alias("c")))


def _buckets(members: DataFrame) -> DataFrame:
    """Members (key, v, ...) of buckets of two or more, with the least node p."""
    least = members.groupBy("key").agg(F.min("v").alias("p"), F.count("*").alias("times")).where("times > 1")
    return members.join(least.drop("times"), "key")


BLOCK = 256     # members of a bucket that one task compares with as many others


def block_links(members: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links between members of one bucket (key, v, n, m, c, j, keys, s)
    that are in different components. A bucket is dealt into blocks, each pair
    of blocks is one group of at most about ``2 x BLOCK`` rows, and only links
    leave it. A pair is looked at in the first band that it shares."""
    count = members.groupBy("key").agg(F.count("*").alias("times"))
    dealt = (members.join(count, "key").withColumn("blocks", F.ceil(F.col("times") / BLOCK).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")))

    def compared(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("v", ignore_index=True)
        keys = np.stack(pdf["keys"].to_numpy())
        band = int(np.flatnonzero(keys[0] == pdf["key"].iloc[0])[0])
        v, n, m, c = (pdf[x].to_numpy() for x in ("v", "n", "m", "c"))
        j, own = pdf["j"].to_numpy(float), pdf["own"].to_numpy()
        sets = [_numbers(x) for x in pdf["s"]]
        same_block = pdf["lo"].iloc[0] == pdf["hi"].iloc[0]
        found = []
        for k in range(len(pdf) - 1):
            rest = slice(k + 1, None)
            both = np.minimum(m[k], m[rest])
            with np.errstate(invalid="ignore"):
                may = (c[rest] != c[k]) & (both >= threshold * (n[k] + n[rest] - both) - 1e-9) \
                    & ~(np.abs(j[rest] - j[k]) > 1 - threshold + 1e-9)
            may &= ~(keys[rest, :band] == keys[k, :band]).any(axis=1)
            if not same_block:
                may &= own[rest] != own[k]
            at = np.flatnonzero(may) + k + 1
            if not len(at):
                continue
            flat = np.concatenate([sets[x] for x in at])
            where = np.minimum(np.searchsorted(sets[k], flat), len(sets[k]) - 1)
            hits = np.add.reduceat(sets[k][where] == flat, np.cumsum([0, *(len(sets[x]) for x in at[:-1])]))
            alike = hits / (n[k] + n[at] - hits)
            found += [(v[k], v[x]) for x in at[alike >= threshold]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return (dealt.select("key", "lo", "hi", "own", "v", "n", "m", "c", "j", "keys", "s")
            .groupBy("key", "lo", "hi").applyInPandas(compared, "a long, b long"))


def near_duplicate_nodes(docs: DataFrame, signed: DataFrame, threshold: float = THRESHOLD,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(v, c): nodes that have a link, with their component."""
    nodes = (signed.where("v is not null").groupBy("v")
             .agg(F.min("dk").alias("dk"), F.any_value("keys").alias("keys")))
    met = staged(_buckets(nodes.select("v", "dk", F.explode("keys").alias("key"))).drop("p"), "buckets")
    wanted = staged(met.select("v", "dk").distinct(), "wanted")
    sets = staged(shingle_sets(docs, wanted, id_col, text_col), "sets")

    # a partner has none of a node's own shingles: that bounds every similarity
    sizes = (sets.select("v", "n").join(own_shingles(sets), "v", "left")
             .select("v", "n", (F.col("n") - F.coalesce("u", F.lit(0))).alias("m"))
             .where(F.col("m") >= threshold * F.col("n") - 1e-9))
    members = staged(_buckets(met.select("key", "v").join(staged(sizes, "sizes"), "v")), "alive")

    def possible(n1: str, m1: str, n2: str, m2: str):
        both = F.least(m1, m2)
        return both >= threshold * (F.col(n1) + F.col(n2) - both) - 1e-9

    pivots = members.where("v = p").select("key", F.col("n").alias("pn"), F.col("m").alias("pm"))
    pairs = staged(members.where("v != p").join(pivots, "key").where(possible("n", "m", "pn", "pm"))
                   .select(F.col("v").alias("a"), F.col("p").alias("b")).distinct(), "pairs")
    first = staged(similarities(pairs, sets), "similar")
    joined = staged(components(first.where(F.col("j") >= threshold).select("a", "b")), "components")

    # what a bucket still holds apart, with its similarity to the least node where that is known
    placed = (members.join(joined, "v", "left").withColumn("c", F.coalesce("c", "v"))
              .join(first.select(F.col("a").alias("v"), F.col("b").alias("p"), "j"), ["v", "p"], "left"))
    apart = (placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"),
                                       F.count_if(F.col("v") != F.col("p")).alias("others"))
             .where("lo != hi and others > 1").select("key"))
    rest = (placed.where(F.col("v") != F.col("p")).join(apart, "key")
            .join(nodes.select("v", "keys"), "v").join(sets.select("v", "s"), "v"))
    second = block_links(staged(rest, "apart"), threshold)
    # the first components stand for their links
    return components(joined.select(F.col("v").alias("a"), F.col("c").alias("b")).unionByName(second))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, dk, class_id, first_dk) of every row: its row key, the smallest
    doc_id of its class and the row key of that document."""
    signed = staged(signature_table(docs, id_col, text_col), "signed")
    found = near_duplicate_nodes(docs, signed, threshold, id_col, text_col)
    rows = signed.select("doc_id", "dk", "v").join(found, "v", "left")
    # rows without words stand alone, by their key
    rows = staged(rows.select("doc_id", "dk", F.coalesce("c", "v", "dk").alias("c"),
                              F.col("v").isNull().alias("bare")), "classes")
    heads = rows.groupBy("c", "bare").agg(F.min("doc_id").alias("class_id"),
                                          F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "dk")).alias("h"))
    return (rows.join(heads, ["c", "bare"])
            .select("doc_id", "dk", "class_id", F.col("h.dk").alias("first_dk")))


def keep_one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` for each class, the one with the smallest doc_id.

    The rows to leave out are a narrow table of their own, so that a small one
    needs no shuffle of the documents."""
    rows = near_duplicates(docs, threshold)
    # rows equal in doc_id and text share a key; one of them stays
    keys = rows.groupBy("dk").agg(F.count("*").alias("times"), F.max((F.col("dk") == F.col("first_dk"))).alias("head"))
    special = staged(keys.where("not head or times > 1"), "special")
    own = [f"c{k}" for k in range(len(docs.columns))]
    at = {c: own[k] for k, c in enumerate(docs.columns)}
    keyed = docs.toDF(*own).withColumn("dk", row_key(F.col(at["doc_id"]), F.col(at["text"])))
    alone = keyed.join(special.select("dk"), "dk", "left_anti")
    repeated = keyed.join(special.where("head").select("dk"), "dk", "left_semi").dropDuplicates(["dk"])
    return alone.unionByName(repeated).select(*own).toDF(*docs.columns)
