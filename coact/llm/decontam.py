"""Benchmark decontamination by a BM25 index of the test items.

The test items are indexed, the training passages are the queries. Impacts are
BM25 term scores divided by the item's score for its own text, so that a
passage scores between 0 and 1 for every item and one threshold fits all.
Passages are overlapping windows of a document's words (those with more than
punctuation, as in the items), twice as long as the longest item and half a
window apart: each occurrence of an item lies whole in one of them.

Retrieval is block-max WAND over blocks of ``BLOCK_ITEMS`` items: the sum of the
largest impacts of a passage's terms bounds every score, the sum of the largest
impacts inside a block bounds the scores there, and only blocks whose bound
reaches the threshold are scored; the postings of other blocks are skipped. So
all items above the threshold are retrieved. Every hit is verified on the words
themselves: the shares of the question's 5-grams and of the answer's 2-grams that
the passage has. The answer is the last sentence of an item, at least its last
``ANSWER_WORDS`` words.

Index sizes: items are dealt by hash to indexes of about ``INDEX_CHARS``
characters of item text; each is collected and broadcast on its own, and the
documents pass once for each. A usual benchmark is one index. Term statistics,
mean length and passage length are those of all items, computed by Spark, so a
score does not depend on the number of indexes. Documents never leave their
partition: one pass, no shuffle of texts.

Defined results: null or empty texts and items never match; an item of fewer
than ``MIN_ITEM_WORDS`` words has too few for scores and matches where all its
words stand in a row (score and shares 1); an item of one word, which has no
question and answer, never matches; repeated items each match; repeated documents
each match; of an item's verified passages the one with the highest score is
reported, of equal ones the first.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hold, staged, words_of

K1, B = 1.2, 0.75
THRESHOLD = 0.5              # of an item's own score
QUESTION_SHARE, ANSWER_SHARE = 0.5, 0.5
QUESTION_GRAM, ANSWER_GRAM = 5, 2
ANSWER_WORDS = 3
MIN_ITEM_WORDS = 8
MIN_STRIDE = 64
BLOCK_ITEMS = 32
INDEX_CHARS = 16_000_000

_TRIM = ".,;:!?()[]{}<>\"'"
_CACHE_WORDS = 300_000
_NO_WORD = -2                # stands for punctuation alone


def normal_words(text: str | None) -> list[str]:
    """Lower-case words without outer punctuation."""
    return [w for w in (x.strip(_TRIM) for x in words_of(text.lower() if text else None)) if w]


def split_item(text: str) -> tuple[list[str], list[str]]:
    """Words of question and answer."""
    raw = text.rstrip().rstrip(".!?").replace("\n", ". ")
    cut = max(raw.rfind(c) for c in (". ", "? ", "! "))
    words = normal_words(text)
    n = max(ANSWER_WORDS, len(normal_words(raw[cut + 2:])) if cut >= 0 else 0)
    n = min(n, len(words) // 2)
    return words[:len(words) - n], words[len(words) - n:]


def grams(words: list[str], n: int) -> set[tuple[str, ...]]:
    n = max(1, min(n, len(words)))
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if words else set()


@dataclass(frozen=True)
class Statistics:
    """What scores take from the items with at least ``MIN_ITEM_WORDS`` words, over all of them."""

    items: int
    words: int
    longest: int
    having: dict[str, int]        # items with a term; terms of one index are enough

    @staticmethod
    def of(counts: list[dict[str, int]]) -> Statistics:
        sizes = [sum(own.values()) for own in counts]
        return Statistics(len(counts), sum(sizes), max(sizes, default=0), dict(Counter(w for own in counts for w in own)))


class Index:
    """Postings with impacts, by term and block; block maxima; the items' grams."""

    def __init__(self, items: list[tuple[object, str]], threshold: float = THRESHOLD,
                 statistics: Statistics | None = None):
        self.threshold = threshold
        split = [(i, t, normal_words(t)) for i, t in items if t]
        kept = [own for own in split if len(own[2]) >= MIN_ITEM_WORDS]
        short = [own for own in split if 2 <= len(own[2]) < MIN_ITEM_WORDS]
        self.ids = [i for i, _, _ in kept + short]
        self.parts = [split_item(t) for _, t, _ in kept]
        counts = [dict(Counter(w)) for _, _, w in kept]
        all_items = statistics or Statistics.of(counts)
        n, mean = all_items.items, all_items.words / max(1, all_items.items)
        self.stride = max(MIN_STRIDE, all_items.longest)
        vocabulary = {w for own in counts for w in own} | {w for _, _, words in short for w in words}
        self.terms = {w: k for k, w in enumerate(sorted(vocabulary))}
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for item, own in enumerate(counts):
            size, impact = sum(own.values()), {}
            for w, tf in own.items():
                idf = np.log(1 + (n - all_items.having[w] + 0.5) / (all_items.having[w] + 0.5))
                impact[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))
            whole = sum(impact.values())
            for w, x in impact.items():
                postings[self.terms[w]].append((item, x / whole))
        # flat arrays for all terms: postings of term t are [begin[t], begin[t + 1]), its entries (one a
        # block) [block_begin[t], block_begin[t + 1]); postings of entry e are [entry_begin[e], entry_begin[e + 1])
        self.begin = np.cumsum([0, *map(len, postings)])
        flat = [p for own in postings for p in own]
        self.item = np.array([p[0] for p in flat], np.int64)
        self.impact = np.array([p[1] for p in flat], np.float64)
        self.blocks = -(-len(kept) // BLOCK_ITEMS)
        term = np.repeat(np.arange(len(postings)), np.diff(self.begin))
        block = self.item // BLOCK_ITEMS
        new = np.ones(len(flat), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        starts = np.flatnonzero(new)
        self.entry_begin = np.append(starts, len(flat))
        self.block = block[starts]
        self.block_max = np.maximum.reduceat(self.impact, starts) if len(starts) else np.zeros(0)
        self.block_begin = np.searchsorted(starts, self.begin)
        self.most = np.array([max((x for _, x in own), default=0.0) for own in postings])
        self.short: dict[int, dict[tuple[int, ...], list[int]]] = {}
        for k, (_, _, words) in enumerate(short, len(kept)):
            row = tuple(self.terms[w] for w in words)
            self.short.setdefault(len(row), {}).setdefault(row, []).append(k)
        self.short_first = {size: np.isin(np.arange(len(self.terms)), [row[0] for row in rows])
                            for size, rows in self.short.items()}

    @staticmethod
    def _spans(begin: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Positions of all entries of ``terms``."""
        n = begin[terms + 1] - begin[terms]
        ends = np.cumsum(n)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[terms] - (ends - n), n)

    def above(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Items whose score for these distinct terms reaches the threshold."""
        if self.most[terms].sum() < threshold:
            return []
        at = self._spans(self.block_begin, terms)
        bounds = np.bincount(self.block[at], self.block_max[at], self.blocks)
        open_blocks = bounds >= threshold
        if not open_blocks.any():
            return []
        at = self._spans(self.entry_begin, at[open_blocks[self.block[at]]])
        score = np.bincount(self.item[at], self.impact[at], len(self.ids))
        return [(k, float(score[k])) for k in np.flatnonzero(score >= threshold).tolist()]

    def promising(self, terms: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Start and distinct terms of the passages whose terms' largest impacts
        reach the threshold together (-1 stands for words that no item has)."""
        n, size = len(terms), 2 * self.stride
        starts = np.arange(0, max(1, n - self.stride), self.stride)
        order = np.argsort(terms, kind="stable")
        again = np.flatnonzero(terms[order[1:]] == terms[order[:-1]])
        before = np.full(len(starts) * self.stride + size, -1)
        before[order[again + 1]] = order[again]
        value = np.zeros(len(before))
        value[:n] = np.where(terms < 0, 0.0, self.most[terms])
        at = starts[:, None] + np.arange(size)
        # a term counts where it occurs first in the passage
        first = (before[at] < starts[:, None]) & (value[at] > 0)
        for k in np.flatnonzero((value[at] * first).sum(axis=1) >= self.threshold - 1e-9):
            yield int(starts[k]), terms[at[k][first[k]]]

    def in_a_row(self, terms: np.ndarray) -> Iterator[int]:
        """Short items whose words all stand in a row."""
        for size, rows in self.short.items():
            head = terms[:max(0, len(terms) - size + 1)]
            at = np.flatnonzero(head >= 0)
            for k in at[self.short_first[size][head[at]]].tolist():
                yield from rows.get(tuple(terms[k:k + size].tolist()), ())

    def verified(self, text: str | None) -> Iterator[tuple[int, float, float, float]]:
        """(item, score, question share, answer share) of every passage that holds
        an item, in the order of the passages."""
        raw = text.encode().split() if text and self.ids else []     # the same words as words_of
        if not raw:
            return
        if _terms.owner is not self:
            _terms.clear()
            _terms.owner = self
        terms = np.fromiter(map(_terms.__getitem__, raw), np.int64, len(raw))
        if (terms == _NO_WORD).any():
            raw = [w for w, t in zip(raw, terms.tolist()) if t != _NO_WORD]
            terms = terms[terms != _NO_WORD]
        for item in self.in_a_row(terms):
            yield item, 1.0, 1.0, 1.0
        for start, own in self.promising(terms):
            passage, having = None, {}
            for item, score in self.above(own, self.threshold):
                if passage is None:
                    passage = normal_words(b" ".join(raw[start:start + 2 * self.stride]).decode())
                shares = []
                for part, n in zip(self.parts[item], (QUESTION_GRAM, ANSWER_GRAM)):
                    wanted = grams(part, n)
                    size = len(next(iter(wanted)))
                    if size not in having:
                        having[size] = grams(passage, size)
                    shares.append(len(wanted & having[size]) / len(wanted))
                if shares[0] >= QUESTION_SHARE and shares[1] >= ANSWER_SHARE:
                    yield item, score, *shares

    def leaks(self, text: str | None) -> list[tuple]:
        """(item id, score, question share, answer share) of verified items."""
        best: dict[int, tuple[float, float, float]] = {}
        for item, *own in self.verified(text):
            if item not in best or own[0] > best[item][0]:
                best[item] = tuple(own)
        return [(self.ids[item], *own) for item, own in sorted(best.items())]

    def leaked(self, text: str | None) -> bool:
        """Whether any item has a verified passage."""
        return next(self.verified(text), None) is not None


class _Terms(dict):
    """Term numbers of words as they stand in texts, for one index at a time."""

    owner: Index | None = None

    def __missing__(self, word: bytes) -> int:
        bare = word.decode().lower().strip(_TRIM)
        got = self.owner.terms.get(bare, -1) if bare else _NO_WORD
        if len(self) < _CACHE_WORDS:
            self[word] = got
        return got


_terms = _Terms()


def item_words(dealt: DataFrame) -> DataFrame:
    """(part, n, terms) of every item: its number of words and its distinct words."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [normal_words(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(w) for w in words], pa.int64()),
                 pa.array([sorted(set(w)) for w in words], pa.list_(pa.string()))], ["part", "n", "terms"])

    return dealt.select("part", "t").mapInArrow(counted, "part long, n long, terms array<string>")


def indexes(items: DataFrame, threshold: float, id_col: str = "item_id", text_col: str = "text") -> Iterator:
    """Broadcast indexes of bounded size that together hold every item, with the statistics of all."""
    own = items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t is not null")
    chars = own.agg(F.sum(F.length("t"))).first()[0] or 0
    parts = max(1, -(-chars // INDEX_CHARS))
    dealt = own.withColumn("part", F.pmod(F.xxhash64("i", "t"), F.lit(parts)).cast("long"))
    words = staged(item_words(dealt), "item-words").where(F.col("n") >= MIN_ITEM_WORDS)
    n, total, longest = words.agg(F.count("*"), F.sum("n"), F.max("n")).first()
    having = words.select(F.explode("terms").alias("w")).groupBy("w").agg(F.count("*").alias("c"))
    for k in range(parts):
        rows = sorted((tuple(r) for r in dealt.where(F.col("part") == k).select("i", "t").collect()), key=repr)
        mine = words.where(F.col("part") == k).select(F.explode("terms").alias("w")).distinct()
        # as many terms as one index has
        counts = {r.w: r.c for r in having.join(mine, "w", "left_semi").collect()}
        yield items.sparkSession.sparkContext.broadcast(
            Index(rows, threshold, Statistics(n, total or 0, longest or 0, counts)))


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
               id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(doc_id, item_id, score, question_share, answer_share) of every verified
    pair, at its best passage."""
    kinds = dict(docs.dtypes)[id_col], dict(items.dtypes)[item_col]
    declared = f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, question_share double, answer_share double"
    out = None
    for shared in indexes(items, threshold, item_col):
        def searched(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hold(_terms)
            index = shared.value
            for b in batches:
                row, hits = [], []
                for k, t in enumerate(b.column(1).to_pylist()):
                    own = index.leaks(t)
                    row += [k] * len(own)
                    hits += own
                if hits:
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(row, pa.int64())),
                         pa.array([h[0] for h in hits]).cast(item_type),
                         *(pa.array([h[k] for h in hits], pa.float64()) for k in (1, 2, 3))],
                        ["doc_id", "item_id", "score", "question_share", "answer_share"])

        from pyspark.sql.pandas.types import to_arrow_type

        item_type = to_arrow_type(items.schema[item_col].dataType)
        own = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
               .mapInArrow(searched, declared))
        out = own if out is None else out.unionByName(own)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a verified leak, with all their columns."""
    at = docs.columns.index(text_col)
    own = [f"c{k}" for k in range(len(docs.columns))]
    out = docs.toDF(*own)
    for shared in indexes(items, threshold):
        def kept(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hold(_terms)
            index = shared.value
            for b in batches:
                clean = [not index.leaked(t) for t in b.column(at).to_pylist()]
                yield b.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(kept, out.schema)
    return out.toDF(*docs.columns)
