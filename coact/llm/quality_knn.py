"""Quality classifier: nearest-neighbour voting among latent-semantic vectors.

Terms of a text are hashed words and structure terms (word shapes, repeated
neighbours, repeated windows and lines, stops). Their relative frequencies,
weighted by inverse document frequency over all training rows, are projected to
``RANK`` latent dimensions by a truncated SVD of the labelled vectors and scaled
to length 1. The labelled vectors are broadcast, at most ``LABELLED x RANK``
floats; every document takes the exact cosine with all of them in one matrix
product per block of documents, and its ``NEIGHBOURS`` nearest vote with the
fourth power of their cosine.

The labelled rows are a bounded sample (``LABELLED``, the training rows with the
smallest hash of their id, half for each label as far as there are so many);
document frequencies cover every training row.

Defined results: a null text or one without words scores 0; a text without a
positive cosine gets the share of label 1 in the sample, as does every text
when no label could be learned from; equal cosines go to the smaller doc_id;
repeated labels of an id count once (the lowest); repeated rows are each scored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .quality_rules import SPACES, SYMBOLS, WINDOW, repeated_words

WORD_TERMS, SHAPES = 512, 256
EXTRA = ("adjacent", "window", "line", "stop", "seen")
TERMS = WORD_TERMS + SHAPES + len(EXTRA)
WORD_WEIGHT = 0.35           # of the words' block beside the structure's
RANK = 48
LABELLED = 4096
NEIGHBOURS = 25
THRESHOLD = 0.7
BLOCK = 500                  # documents in one matrix product

_CACHE_WORDS = 300_000
_cache: dict[bytes, int] = {}


def _shape(word: bytes) -> bytes:
    out = []
    for c in word.decode():
        k = "d" if c.isdigit() else "u" if c.isupper() else "a" if c.isalpha() else "#" if c in SYMBOLS else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out[:8]).encode()


def _term(word: bytes) -> int:
    """Shape bucket and word bucket in one number."""
    got = _cache.get(word)
    if got is None:
        if len(_cache) >= _CACHE_WORDS:
            _cache.clear()
        shape = zlib.crc32(_shape(word)) % SHAPES
        got = _cache[word] = shape * WORD_TERMS + zlib.crc32(word.lower()) % WORD_TERMS
    return got


def term_counts(text: str | None) -> np.ndarray:
    """Counts of all terms of a whole text, divided by its words; zeros without words."""
    out = np.zeros(TERMS, np.float32)
    words = text.encode().split() if text else []
    n = len(words)
    if not n:
        return out
    both = np.fromiter(map(_term, words), np.int64, n)
    out[:WORD_TERMS] = np.bincount(both % WORD_TERMS, minlength=WORD_TERMS)
    out[WORD_TERMS:WORD_TERMS + SHAPES] = np.bincount(both // WORD_TERMS, minlength=SHAPES)
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    out[WORD_TERMS + SHAPES:] = (
        (ids[1:] == ids[:-1]).sum(), repeated_words(ids, WINDOW) if n > WINDOW else 0,
        (len(lines) - len(set(lines))) * n / len(lines), text.count(". ") + text.count(".\n"),
        (n - len(names)) / (1.0 + np.log1p(n) / 4))
    return out / n


def _frequencies(df: DataFrame, text: Column, key: Column, chosen: list[int]) -> DataFrame:
    """From every row: a row per task with its rows and its rows having each term
    (null id), and the vectors of the chosen ids."""
    wanted = df.sparkSession.sparkContext.broadcast(set(chosen))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, having = 0, np.zeros(TERMS)
        for b in batches:
            ids, kept = [], []
            for t, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                v = term_counts(t)
                rows += 1
                having += v > 0
                if k in wanted.value:
                    ids.append(k)
                    kept.append(v)
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.nulls(len(ids), pa.int64()),
                     pa.array([v.astype(float) for v in kept], pa.list_(pa.float64()))], ["id", "n", "v"])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.array([rows], pa.int64()),
             pa.array([having], pa.list_(pa.float64()))], ["id", "n", "v"])

    out = (df.select(text.alias("text"), key.cast("long").alias("id"))
           .mapInArrow(counted, "id long, n long, v array<double>"))
    return staged(out, "terms")


def learn(df: DataFrame, labels: DataFrame, text: Column, key: Column,
          labelled: int = LABELLED) -> dict | None:
    """Model from the rows of ``df`` (training rows only) and ``labels``
    (``doc_id``, ``quality``); None without labelled rows."""
    once = (labels.where("doc_id is not null and quality in (0, 1)")
            .groupBy("doc_id").agg(F.min("quality").alias("y")))
    train = df.select(key.cast("long").alias("id"), text.alias("text"))
    own = staged(once.join(train.select(F.col("id").alias("doc_id")).distinct(), "doc_id"), "labels")
    order = F.xxhash64(F.lit("sample"), "doc_id")
    sides = [own.where(F.col("y") == y).orderBy(order, "doc_id").limit(labelled).collect() for y in (0, 1)]
    half = labelled // 2
    few = min(range(2), key=lambda k: len(sides[k]))
    share = [0, 0]
    share[few] = min(half, len(sides[few]))
    share[1 - few] = min(labelled - share[few], len(sides[1 - few]))
    y = {r["doc_id"]: r["y"] for s, n in zip(sides, share) for r in s[:n]}
    if not y:
        return None
    out = _frequencies(train, F.col("text"), F.col("id"), list(y))
    folded = (out.where("id is null").select("n", F.posexplode("v").alias("t", "x"))
              .groupBy("t").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect())
    having, rows = np.zeros(TERMS), 1
    for r in folded:
        having[r["t"]], rows = r["x"], r["n"]
    kept = out.where("id is not null").groupBy("id").agg(F.min("v").alias("v")).orderBy("id").collect()
    ids = np.array([r["id"] for r in kept], np.int64)
    x = np.array([r["v"] for r in kept], np.float32).reshape(len(ids), TERMS)
    weight = (np.log((1 + rows) / (1 + having)) + 0.1).astype(np.float32)
    weight[:WORD_TERMS] *= WORD_WEIGHT
    x = np.sqrt(x) * weight
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    values, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    basis = vectors[:, np.argsort(-values)[:RANK]].astype(np.float32)
    z = x @ basis
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
    return {"weight": weight, "basis": basis, "z": z, "y": np.array([y[i] for i in ids.tolist()], np.float32)}


def nearest(near: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest values of each row; of values equal to the
    k-th, those at the smallest positions (labelled rows are in doc_id order)."""
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(near, top, 1).min(axis=1)
    # argpartition takes any of the tied ones: rows with more of them than places are picked anew
    for r in np.nonzero((near >= least[:, None]).sum(axis=1) > k)[0]:
        above = np.nonzero(near[r] > least[r])[0]
        top[r] = np.concatenate([above, np.nonzero(near[r] == least[r])[0][:k - len(above)]])
    return top


def score(df: DataFrame, text: Column, keep: list[str], model: dict | None) -> DataFrame:
    """Columns ``keep`` with ``score`` for every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def voted(texts: list) -> np.ndarray:
        m = shared.value
        x = np.array([term_counts(t) for t in texts], np.float32).reshape(len(texts), TERMS)
        none = ~x.any(axis=1)
        if m is None:
            return np.where(none, 0.0, 0.5)
        z = (np.sqrt(x) * m["weight"]) @ m["basis"]
        z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
        near = z @ m["z"].T
        top = nearest(near, min(NEIGHBOURS, near.shape[1]))
        w = np.maximum(np.take_along_axis(near, top, 1), 0.0).astype(np.float64) ** 4
        sums = w.sum(axis=1)
        out = np.where(sums > 0, (w * m["y"][top]).sum(axis=1) / np.maximum(sums, 1e-300), m["y"].mean())
        return np.where(none, 0.0, np.clip(out, 0.0, 1.0))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(voted(part.column(0).to_pylist()), pa.float64())],
                    [*keep, "score"])

    schema = df.select(*keep).withColumn("score", F.lit(0.0)).schema
    return df.select(text.alias("_text"), *keep).mapInArrow(scored, schema)
