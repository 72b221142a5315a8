"""Hard negatives by angular triangle filtering.

Every row is stored with its norm and its angles to ``REFERENCES`` directions.
For an anchor ``a``, a row ``x`` and a direction ``r`` the triangle inequality
on the sphere gives

    |ang(a, r) - ang(x, r)|  <=  ang(a, x)  <=  min(s, 2 pi - s),  s = ang(a, r) + ang(x, r)

so all directions together bound the cosine, and the norms turn it into bounds
of the integer score, rounded outwards. Only pairs whose bounds overlap a window
of wanted scores are scored, exactly, in integers.

1. *Index.* Components become ``floor(256 x)``; the directions are the centres of
   a few rounds of spherical k-means over at most ``SAMPLE`` rows (the results do
   not depend on them). All rows are written in the order of their nearest
   direction and the angle to it, so rows that lie together are alike.
2. *Search.* Anchors are taken in chunks of at most ``CHUNK``, a bound on what is
   broadcast at once. Every task reads its rows in segments of ``SEGMENT``: the
   ranges of a segment's angles and norms rule out anchors, then each row's own
   angles rule out pairs; what is left is scored. A window keeps its best
   ``k`` rows and thereby rises from below as the task goes on.
3. A first search finds the positives (same label, no upper end), a second one the
   negatives (other label, one window ``[ceil(0.8 p), p]`` per positive score p).
   Tasks return at most ``k`` rows per window, which a partial and a final rank
   reduce.

Scores are exact: sums that 53 bits hold by matrix products of doubles, others
by Python integers, limited to 64 bits in the end.

Defined results: rows with a null label, a null vector, or a null or non-finite
component take no part; a shorter vector counts as filled with zeros; ``other rows``
of an anchor are those with another vec_id; rows that repeat a vec_id are rows of
their own, anchors equal in id, label and vector count once; a null vec_id is no
anchor and ranks last among ties; an anchor without positives, or a positive
without negatives, gives no row; an empty table gives none. Columns beside the
three named ones take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coact.session import default_parallelism, scratch_dir

from .common import staged

REFERENCES = 16
SAMPLE = 2048           # rows that the directions are fitted on
CHUNK = 16384           # anchors broadcast at a time, about half of it on average
SEGMENT = 256
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100     # per cent of a positive's score between which negatives lie
SCALE = 256
SLACK = 1e-6            # radians; arc cosines of doubles are right to about 2e-8
_NONE = _MOST = np.iinfo(np.int64).max
_LEAST = np.iinfo(np.int64).min


# --- index -----------------------------------------------------------------------

def quantised(rows: list[list[float]], width: int) -> np.ndarray:
    """``floor(256 x)`` as 64-bit integers (limited to 62 bits), zeros to ``width``."""
    out = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    with np.errstate(over="ignore"):
        return np.clip(np.floor(out * SCALE), -(2.0 ** 62), 2.0 ** 62).astype(np.int64)


def angles_to(q: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms and angles; a zero vector has angle 0 to everything (its score is 0)."""
    x = q.astype(np.float64)
    norms = np.sqrt((x * x).sum(axis=1))
    cos = (x / np.maximum(norms, 1e-300)[:, None]) @ directions.T
    cos[norms == 0] = 1.0
    return norms, np.arccos(np.clip(cos, -1.0, 1.0))


def fit_directions(q: np.ndarray, n: int = REFERENCES, rounds: int = 8) -> np.ndarray:
    """Unit centres of spherical k-means, deterministic."""
    x = q.astype(np.float64)
    x = x[(x != 0).any(axis=1)]
    width = q.shape[1]
    if not len(x):
        return np.eye(max(width, 1))[:1, :width] if width else np.zeros((1, 0))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    picks = [0]                         # farthest first
    near = x @ x[0]
    while len(picks) < min(n, len(x)):
        picks.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[picks[-1]])
    c = x[picks]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        size = np.sqrt((sums * sums).sum(axis=1))
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-300)[:, None], c)
    return c


_ROW = "vec_id long, label long, ref int, angle double, norm double, angles array<double>, q binary"


def _vectors(data: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(data), "<i8").reshape(len(data), width)


def valid_rows(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v): rows that take part, with the label that counts."""
    vec = F.col(vec_col)
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    own, label = F.col(id_col).cast("long"), F.col(label_col).cast("long")
    return (df.where(label.isNotNull() & vec.isNotNull() & ~bad)
            .select(own.alias("vec_id"),
                    F.when(F.pmod(own, F.lit(7)) == 0, (label + 1) % F.lit(10)).otherwise(label).alias("label"),
                    vec.cast("array<double>").alias("v")))


class Sample:
    """The rows that the directions are fitted on, and the directions."""

    def __init__(self, rows: list, width: int):
        self.vec_id = np.array([_NONE if r["vec_id"] is None else r["vec_id"] for r in rows], np.int64)
        self.label = np.array([r["label"] for r in rows], np.int64)
        self.q = quantised([r["v"] for r in rows], width)
        self.directions = fit_directions(self.q)
        self.norms, self.angles = angles_to(self.q, self.directions)


def build_index(df: DataFrame, path: str, id_col: str = "vec_id", vec_col: str = "embedding",
                label_col: str = "label") -> tuple[int, Sample]:
    """Write all rows that take part to ``path``; the width of the vectors and the sample."""
    spark = df.sparkSession
    rows = valid_rows(df, id_col, vec_col, label_col)
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    order = F.xxhash64(F.lit("directions"), "vec_id", "label", "v")
    sample = Sample(rows.orderBy(order, "vec_id", "label", "v").limit(SAMPLE).collect(), width)
    shared = spark.sparkContext.broadcast(sample.directions)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = quantised(b.column(2).to_pylist(), width)
            norms, angles = angles_to(q, shared.value)
            ref = np.argmin(angles, axis=1) if len(q) else np.zeros(0, np.int64)
            raw = q.astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(ref.astype(np.int32)),
                 pa.array(angles[np.arange(len(q)), ref]), pa.array(norms),
                 pa.array(list(angles), pa.list_(pa.float64())), pa.array([x.tobytes() for x in raw], pa.binary())],
                ["vec_id", "label", "ref", "angle", "norm", "angles", "q"])

    index = rows.mapInArrow(placed, _ROW)
    # the id parts copies of one vector
    keys = ["ref", "angle", "vec_id"]
    (index.repartitionByRange(default_parallelism(spark), *keys).sortWithinPartitions(*keys)
     .write.option("compression", "zstd").parquet(path))
    return width, sample


# --- bounds ------------------------------------------------------------------------

def cosine_bounds(low_a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest cosine of anchors (n x refs) and rows whose angles lie
    in [low, high] (m x refs), each m x n."""
    nearest = np.zeros((len(low), len(low_a)))
    farthest = np.full(nearest.shape, np.pi)
    for k in range(low_a.shape[1]):
        a = low_a[:, k][None, :]
        lo, hi = low[:, k][:, None], high[:, k][:, None]
        np.maximum(nearest, np.maximum(lo - a, a - hi), out=nearest)
        np.minimum(farthest, np.minimum(a + hi, 2 * np.pi - a - lo), out=farthest)
    return (np.cos(np.clip(farthest + SLACK, 0.0, np.pi)), np.cos(np.clip(nearest - SLACK, 0.0, np.pi)))


def score_bounds(cos_low: np.ndarray, cos_high: np.ndarray, norm_a: np.ndarray, norm_low: np.ndarray,
                 norm_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score bounds, rounded outwards beyond the errors of the doubles."""
    n = norm_a[None, :]
    small, large = norm_low[:, None] * n, norm_high[:, None] * n
    low = np.where(cos_low >= 0, cos_low * small, cos_low * large)
    high = np.where(cos_high >= 0, cos_high * large, cos_high * small)
    safe = 1.0 + large * 1e-9
    return np.floor(low - safe), np.ceil(high + safe)


def exact_scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Integer inner products, rows x anchors."""
    if not rows.size or not anchors.size:
        return np.zeros((len(rows), len(anchors)), np.int64)
    most = float(np.abs(rows).max()) * float(np.abs(anchors).max()) * rows.shape[1]
    if most < 2.0 ** 53:
        return (rows.astype(np.float64) @ anchors.T.astype(np.float64)).astype(np.int64)
    wide = rows.astype(object) @ anchors.T.astype(object)
    limit = (1 << 63) - 1
    return np.array([[max(-limit, min(limit, int(x))) for x in r] for r in wide], np.int64)


# --- search ------------------------------------------------------------------------

class Anchors:
    """A chunk of anchors and their windows (n x w): lowest and highest wanted
    score, both included; a window with low > high wants nothing."""

    def __init__(self, number, vec_id, label, q, norms, angles, low, high, same: bool, k: int):
        self.number, self.vec_id, self.label = number, vec_id, label
        self.q, self.norms, self.angles = q, norms, angles
        self.low, self.high, self.same, self.k = low, high, same, k


class Best:
    """The best ``k`` rows of each window so far, and the rising low ends."""

    def __init__(self, anchors: Anchors):
        self.k, self.shape = anchors.k, anchors.low.shape
        self.low = anchors.low.copy()
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, window: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self.parts.append((window, ids, scores))
        self.size += len(window)
        if self.size > 4 * self.k * self.low.size + 100_000:
            self.reduce()

    def reduce(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return (np.zeros(0, np.int64),) * 3
        window, ids, scores = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((ids, -scores, window))
        window, ids, scores = window[order], ids[order], scores[order]
        start = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
        rank = np.arange(len(window)) - np.repeat(start, np.diff(np.r_[start, len(window)]))
        last = rank == self.k - 1
        # a score below the k-th best is not wanted any more; an equal one may win by its id
        self.low.reshape(-1)[window[last]] = scores[last]
        kept = rank < self.k
        self.parts = [(window[kept], ids[kept], scores[kept])]
        self.size = int(kept.sum())
        return self.parts[0]


def search_segment(a: Anchors, best: Best, vec_id: np.ndarray, label: np.ndarray, norms: np.ndarray,
                   angles: np.ndarray, q: np.ndarray) -> int:
    """Add a segment's rows to ``best``; returns the number of pairs scored."""
    low, high = best.low.min(axis=1), a.high.max(axis=1)
    c_lo, c_hi = cosine_bounds(a.angles, angles.min(axis=0)[None], angles.max(axis=0)[None])
    s_lo, s_hi = score_bounds(c_lo, c_hi, a.norms, norms.min()[None], norms.max()[None])
    live = np.flatnonzero((s_hi[0] >= low) & (s_lo[0] <= high))
    if not len(live):
        return 0
    c_lo, c_hi = cosine_bounds(a.angles[live], angles, angles)
    s_lo, s_hi = score_bounds(c_lo, c_hi, a.norms[live], norms, norms)
    other = label[:, None] != a.label[live][None, :]
    may = (s_hi >= low[live]) & (s_lo <= high[live])
    may &= (~other & (vec_id[:, None] != a.vec_id[live][None, :])) if a.same else other
    rows, cols = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
    if not len(rows):
        return 0
    sub = may[np.ix_(rows, cols)]
    scores = exact_scores(q[rows], a.q[live[cols]])
    for w in range(a.low.shape[1]):
        at = live[cols]
        hit = sub & (scores >= best.low[at, w]) & (scores <= a.high[at, w])
        r, c = np.nonzero(hit)
        if len(r):
            best.add(at[c] * a.low.shape[1] + w, vec_id[rows[r]], scores[r, c])
    return int(sub.sum())


def raised(a: Anchors, sample: Sample) -> Anchors:
    """The anchors with the low ends that the sample's rows allow: they are rows
    of the index, so the k-th best of them bounds the k-th best of all."""
    best = Best(a)
    for at in range(0, len(sample.q), SEGMENT):
        s = slice(at, at + SEGMENT)
        search_segment(a, best, sample.vec_id[s], sample.label[s], sample.norms[s], sample.angles[s], sample.q[s])
        best.reduce()
    a.low = best.low
    return a


def search(index: DataFrame, width: int, anchors: Anchors, scored=None) -> DataFrame:
    """(anchor, w, vec_id, score): of every task, at most ``k`` rows per window."""
    shared = index.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = shared.value
        best, done = Best(a), 0
        for b in batches:
            col = dict(zip(b.schema.names, b.columns))
            ids = col["vec_id"].fill_null(_NONE).to_numpy(zero_copy_only=False)
            label, norms = col["label"].to_numpy(), col["norm"].to_numpy()
            angles = np.asarray(col["angles"].flatten()).reshape(b.num_rows, -1)
            q = _vectors(col["q"].to_pylist(), width)
            for at in range(0, b.num_rows, SEGMENT):
                s = slice(at, at + SEGMENT)
                done += search_segment(a, best, ids[s], label[s], norms[s], angles[s], q[s])
                best.reduce()
        if scored is not None:
            scored.add(done)
        window, ids, scores = best.reduce()
        n = a.low.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(a.number[window // n], pa.int64()), pa.array((window % n).astype(np.int32), pa.int32()),
             pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], ["anchor", "w", "vec_id", "score"])

    return (index.select("vec_id", "label", "norm", "angles", "q")
            .mapInArrow(run, "anchor long, w int, vec_id long, score long"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _chunks(index: DataFrame, every: int, path: str) -> list[DataFrame]:
    """The anchors, numbered, in chunks of at most ``CHUNK``."""
    spark = index.sparkSession
    own = (index.where(F.pmod("vec_id", F.lit(every)) == 0)
           .dropDuplicates(["vec_id", "label", "q"]))
    # an anchor's chunk is a hash of it: chunks of about half the bound, dealt anew if one exceeds it
    total = own.count()
    n = max(1, -(-2 * total // CHUNK))
    own = own.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "label", "q"), F.lit(n)))
    own.write.partitionBy("chunk").parquet(path)
    chunks = spark.read.parquet(path) if total else own
    return [chunks.where(F.col("chunk") == c) for c in range(n)] if total else []


def _anchors(rows: list, width: int, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> Anchors:
    return Anchors(np.arange(len(rows), dtype=np.int64), np.array([r["vec_id"] for r in rows], np.int64),
                   np.array([r["label"] for r in rows], np.int64), _vectors([r["q"] for r in rows], width),
                   np.array([r["norm"] for r in rows]), np.array([r["angles"] for r in rows]).reshape(len(rows), -1),
                   low, high, same, k)


def mine(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, path: str | None = None, scored=None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    ``scored``: an accumulator for the number of pairs scored in integers."""
    spark = df.sparkSession
    path = path or scratch_dir(spark, "llm-angles")
    width, sample = build_index(df, f"{path}/rows", id_col, vec_col, label_col)
    index = spark.read.parquet(f"{path}/rows")
    out = []
    for chunk in _chunks(index, every, f"{path}/anchors"):
        rows = chunk.orderBy("vec_id", "label", "q").collect()       # about CHUNK / 2
        if not rows:
            continue
        lows, highs = np.full((len(rows), 1), _LEAST), np.full((len(rows), 1), _MOST)
        anchors = raised(_anchors(rows, width, lows, highs, True, positives), sample)
        near = staged(_ranked(search(index, width, anchors, scored), positives), "positives")
        lows, highs = np.full((len(rows), positives), _MOST), np.full((len(rows), positives), _LEAST)
        for r in near.collect():                                     # at most `positives` per anchor
            p, at = r["score"], (r["anchor"], r["rank"] - 1)
            lows[at], highs[at] = max(_LEAST, -(-low * p // 100)), min(_MOST, high * p // 100)
        anchors = raised(_anchors(rows, width, lows, highs, False, negatives), sample)
        second = search(index, width, anchors, scored)
        ids = spark.createDataFrame([(k, r["vec_id"]) for k, r in enumerate(rows)], "anchor long, anchor_id long")
        pos = near.select("anchor", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"),
                          F.col("score").alias("positive_score"))
        got = (_ranked(second, negatives).join(F.broadcast(pos), ["anchor", "w"]).join(F.broadcast(ids), "anchor")
               .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                       F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
        out.append(staged(got, "negatives"))
    if not out:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    all_ = out[0]
    for more in out[1:]:
        all_ = all_.unionByName(more)
    return _with_null_ids(all_)


def _with_null_ids(df: DataFrame) -> DataFrame:
    for c in ("positive_id", "negative_id"):
        df = df.withColumn(c, F.when(F.col(c) != F.lit(_NONE), F.col(c)))
    return df
