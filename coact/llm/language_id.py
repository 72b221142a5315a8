"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent 1- to 3-grams of lower-cased letters
(word ends count as a letter, other characters as word ends), most frequent
first. A document's distance to a language is the out-of-place measure: the sum
over its own profile of the difference between a gram's rank there and in the
language's profile, ``PROFILE`` for a gram that the language lacks.

Learning counts the grams of every training row: each task sums its own counts,
Spark adds them by (language, gram) and keeps the first ``PROFILE`` per
language. The profiles are broadcast with the prediction: at most
``MAX_LANGUAGES x PROFILE`` grams, and more languages than that raise an error.

Defined results: a null text or one without letters is ``und`` with score 0, as
is every text when nothing could be learned; equal distances go to the language
that sorts first; equal counts rank by code point; repeated rows each get their
own result. Texts are read whole, in pieces of bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

PROFILE = 400
MAX_LANGUAGES = 10_000     # more than any list of language codes
PIECE = 1 << 19            # characters whose grams are sorted at once
TASK_GRAMS = 2_000_000     # counts that a learning task holds before it passes them on
UNKNOWN = "und"

_EDGE = 1                  # stands for a word end; never a letter
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Grams of a whole text, as codes in ascending order, and their counts."""
    if not text:
        return _merged([])
    code = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    code = np.where(_is_letter()[code], code, _EDGE).astype(np.int64)
    code = np.concatenate(([_EDGE], code, [_EDGE]))
    code = code[np.concatenate(([True], (code[1:] != _EDGE) | (code[:-1] != _EDGE)))]
    parts = []
    for at in range(0, max(1, len(code) - 1), PIECE):
        c = code[at:at + PIECE + 2]
        one = c[:PIECE]
        two = (c[:-1] << 21 | c[1:])[:PIECE]
        two = two[(two != (_EDGE << 21 | _EDGE))]
        three = c[:-2] << 42 | c[1:-1] << 21 | c[2:]
        grams = np.concatenate((one[one != _EDGE], two, three[c[1:-1] != _EDGE]))
        if len(grams):
            parts.append(np.unique(grams, return_counts=True))
    return _merged(parts)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    return codes[np.argsort(-counts, kind="stable")[:size]]


def learn_profiles(df: DataFrame, text: Column, lang: Column) -> list[tuple[str, list[int]]]:
    """(language, gram codes by rank), sorted by language, from every row given."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def flushed():
            for name, (codes, counts) in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(codes), pa.string()), pa.array(codes), pa.array(counts)],
                    ["lang", "gram", "n"])
            sums.clear()

        for b in batches:
            parts: dict[str, list] = {}
            for t, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = gram_counts(t)
                if len(found[0]):
                    parts.setdefault(name, []).append(found)
            for name, own in parts.items():
                sums[name] = _merged(own + [sums[name]] if name in sums else own)
            if sum(len(c) for c, _ in sums.values()) > TASK_GRAMS:
                yield from flushed()
        yield from flushed()

    rows = df.select(text.alias("text"), lang.alias("lang")).where("text is not null and lang is not null")
    sums = (rows.mapInArrow(counted, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # row_number <= PROFILE is a partial window limit: each task passes on PROFILE grams a language
    top = sums.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE)
    profiles: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "rank").limit(MAX_LANGUAGES * PROFILE + 1).toLocalIterator():
        profiles.setdefault(r["lang"], []).append(r["gram"])
    if len(profiles) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    return sorted(profiles.items())


def predict_language(df: DataFrame, text: Column, keep: list[str],
                     profiles: list[tuple[str, list[int]]]) -> DataFrame:
    """Columns ``keep`` with ``lang_pred`` and ``score`` (1 less the best distance
    over the largest possible)."""
    names = [n for n, _ in profiles]
    grams = np.unique(np.concatenate([np.array(g, np.int64) for _, g in profiles] or [np.empty(0, np.int64)]))
    ranks = np.full((len(names), len(grams) + 1), -1, np.int64)
    for k, (_, g) in enumerate(profiles):
        ranks[k, np.searchsorted(grams, g)] = np.arange(len(g))
    shared = df.sparkSession.sparkContext.broadcast((names, grams, ranks))

    def judged(t: str | None) -> tuple[str, float]:
        names, grams, ranks = shared.value
        own = ranked(*gram_counts(t))
        if not len(own) or not names:
            return UNKNOWN, 0.0
        at = np.searchsorted(grams, own)
        at[at == len(grams)] = 0
        at[grams[at] != own] = len(grams)      # the last column: missing everywhere
        there = ranks[:, at]
        away = np.where(there < 0, PROFILE, np.abs(there - np.arange(len(own)))).sum(axis=1)
        best = int(away.argmin())
        return names[best], 1.0 - float(away[best]) / (PROFILE * len(own))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [judged(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array([x[0] for x in out], pa.string()),
                 pa.array([x[1] for x in out], pa.float64())], [*keep, "lang_pred", "score"])

    kept = df.select(*keep)
    schema = kept.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return df.select(text.alias("_text"), *keep).mapInArrow(predicted, schema)
