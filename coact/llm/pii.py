"""Personal data: fixed patterns, and bootstrapped contextual extraction.

The base patterns (e-mail, IP, card, phone) mark spans leftmost and without
overlap per kind. They also seed the bootstrap:

1. One pass over the whole texts emits, per document, the base spans and every
   *mention*: an identifier-like token with its lexical patterns, letter case and
   digits levelled: the word before it, the two words before it, the word after
   it, and the two before with the one after. Tokens inside base spans are
   mentions of that kind. A token that by itself looks like a key or an access
   token (32 characters or more: hexadecimal digits, or letters of both cases
   with digits) is a seed of a fifth kind, *secret*; all others are unlabelled.
2. Mentions form a graph of patterns and instances. In each of ``ROUNDS``
   rounds Spark scores a pattern by the share of its mentions whose instance is
   known to be of the kind, and an instance by the patterns it occurs in
   (1 less the product of their doubts). Patterns with enough support and
   confidence propose instances. The shapes of a kind are those that enough
   different seeds and proposed instances have, so a form that no base pattern
   knows comes in by its contexts; instances of these shapes teach further
   patterns in the next round.
3. Unlabelled and secret mentions in an accepted pattern, of a shape of its kind,
   become spans of the kind ``method``. A secret counts by its context only: a
   checksum among ordinary words is left alone.

The graph is aggregated by (pattern, instance, kind) before any join, so a
phrase that occurs in a third of all documents is one edge. Joins are on the
pattern or the instance; nothing is broadcast by hand or collected.

Defined results: a null text is an empty one and has no spans; offsets are code
points, end exclusive; a repeated (doc_id, text) row keeps its own base spans
and shares the added ones; a word that does not lie whole within ``BEFORE`` characters
before a mention or ``AFTER`` behind it is no context; a span that patterns of several kinds add stands for the
kind of the most confident one, of equal ones the first kind.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, staged

KINDS = ("email", "ip", "card", "phone")
METHOD = "method"
SECRET = 4               # kind number of tokens that look like keys; no base kind

BEFORE, AFTER = 400, 200
LONG = 64                # longer words, shapes and instances are named by their digest

ROUNDS = 3
MIN_SUPPORT = 5          # distinct known instances that a pattern must have
MIN_CONFIDENCE = 0.8     # share of a pattern's mentions that are known
MIN_SCORE = 0.8          # of an instance

#: Fixed patterns of the contract.
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Tokens that may be identifiers: with a digit or @, at least five characters.
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_HAS_MARK = re.compile(r"[0-9@]")
_TRIM = ".,;:!?()[]{}<>\"'#*$%&|"


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern ``local@domain`` matches leftmost: the local part reaches
    back from the first @ over its characters, not into an earlier match."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _AT.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
            at = text.find("@", last)
        else:
            last = at + 1
            at = text.find("@", last)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base patterns, by kind, then start."""
    if not text:
        return []
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    out += [(1, *m.span()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text)
                if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


_SECRET = re.compile(r"(?=.*[0-9])(?:(?=.*[A-Fa-f])[0-9A-Fa-f]{32,}|(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]{32,})")


def is_secret(token: str) -> bool:
    """Whether a token by itself looks like a key: long, of mixed characters."""
    return len(token) >= 32 and _SECRET.fullmatch(token) is not None


def _named(word: str) -> str:
    """The word, or a long one's digest, so that edges stay narrow and differ."""
    return word if len(word) <= LONG else hashlib.sha256(word.encode("utf-8", "surrogatepass")).hexdigest()


def _level(word: str) -> str:
    return _named(re.sub(r"[0-9]+", "0", word.lower()))


def _shape(token: str) -> str:
    """Character classes of a token, runs as one; of a secret, its length."""
    if is_secret(token):
        return f"secret {len(token)}"
    return _named(re.sub(r"0+", "0", re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]", "0", token))))


def _context(text: str, a: int, b: int) -> tuple[list[str], list[str]]:
    """The two words before ``a`` and the one from ``b`` on, whole words only."""
    lo, hi = max(0, a - BEFORE), min(len(text), b + AFTER)
    before, after = text[lo:a].split(), text[b:hi].split()
    if lo and before and not text[lo - 1].isspace() and not text[lo].isspace():
        before = before[1:]
    if hi < len(text) and after and not text[hi - 1].isspace() and not text[hi].isspace():
        after = after[:-1]
    return before[-2:], after[:1]


def mentions(text: str | None, spans: list[tuple[int, int, int]]) -> list[tuple]:
    """(kind number or -1, start, end, instance, patterns, shape) of every base
    span and of every other identifier-like token."""
    if not text:
        return []
    taken = sorted((a, b, k) for k, a, b in spans)
    found = [(k, a, b) for a, b, k in taken]
    starts = [a for a, _, _ in taken]
    reach = list(accumulate((b for _, b, _ in taken), max))      # of the spans up to each
    # words with a digit or @ are rare: walk from mark to mark, not over every word
    at, end_of_last = _HAS_MARK.search(text), 0
    while at:
        a, b = at.start(), at.end()
        while a > end_of_last and text[a - 1] not in " \t\n\x0b\x0c\r":
            a -= 1
        m = _TOKEN.match(text, b)
        b = m.end() if m else b
        end_of_last = b
        while a < b and text[a] in _TRIM:
            a += 1
        while b > a and text[b - 1] in _TRIM:
            b -= 1
        k = bisect_left(starts, b)
        if b - a >= 5 and not (k and reach[k - 1] > a):
            found.append((SECRET if is_secret(text[a:b]) else -1, a, b))
        at = _HAS_MARK.search(text, end_of_last)
    out = []
    for kind, a, b in found:
        before, after = _context(text, a, b)
        token = text[a:b]
        out.append((kind, a, b, _level_instance(token),
                    _patterns([_level(w) for w in before], [_level(w) for w in after]), _shape(token)))
    return out


def _patterns(before: list[str], after: list[str]) -> list[str]:
    """Every pattern form of a mention; a form of one side needs its words."""
    left = " ".join(["^"] * (2 - len(before)) + before)
    out = [f"{left} _ {after[0] if after else '$'}"]
    out += [f"{before[-1]} _"] if before else []
    out += [f"{left} _"] if len(before) == 2 else []
    return out + ([f"_ {after[0]}"] if after else [])


def _level_instance(token: str) -> str:
    return _named(token.lower())


def scan_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One pass over the whole texts: key, id, base spans and mentions."""
    span = "struct<kind:int,start:long,end:long>"
    mention = "struct<kind:int,start:long,end:long,instance:string,patterns:array<string>,shape:string>"
    kind = dict(df.dtypes)[id_col]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
        mention_type = pa.list_(pa.struct([
            ("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("instance", pa.string()),
            ("patterns", pa.list_(pa.string())), ("shape", pa.string())]))
        for b in batches:
            spans, seen = [], []
            for t in b.column(2).to_pylist():
                own = base_spans(t)
                spans.append([{"kind": k, "start": x, "end": y} for k, x, y in own])
                seen.append([dict(zip(("kind", "start", "end", "instance", "patterns", "shape"), m))
                             for m in mentions(t, own)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(spans, span_type), pa.array(seen, mention_type)],
                ["key", "doc_id", "spans", "mentions"])

    text, own = F.col(text_col), F.col(id_col)
    return (df.select(row_key(own, text).alias("key"), own.alias("doc_id"), text.alias("text"))
            .mapInArrow(scanned, f"key long, doc_id {kind}, spans array<{span}>, mentions array<{mention}>"))


def bootstrap(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Accepted (kind, pattern, shape, confidence) from edges (kind, instance,
    pattern, shape, n); kind -1 is unlabelled."""
    seeds = edges.where("kind >= 0").select("kind", "instance", "shape").distinct()
    known = seeds.select("kind", "instance").distinct()
    accepted = shapes = None
    for _ in range(rounds):
        hits = edges.join(known.withColumnRenamed("kind", "as_kind"), "instance")
        per = (hits.groupBy("as_kind", "pattern")
               .agg(F.sum("n").alias("known_n"), F.countDistinct("instance").alias("support")))
        total = edges.groupBy("pattern").agg(F.sum("n").alias("n"))
        accepted = staged(
            per.where(F.col("support") >= MIN_SUPPORT).join(total, "pattern")
            .select(F.col("as_kind").alias("kind"), "pattern",
                    (F.col("known_n") / F.col("n")).alias("confidence"))
            .where(F.col("confidence") >= MIN_CONFIDENCE), "patterns")
        # an instance's score: one less the product of its patterns' doubts
        doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
        fresh = staged(edges.where("kind < 0").drop("kind").join(accepted, "pattern")
                       .groupBy("kind", "instance", "shape").agg((1 - F.exp(doubt)).alias("score"))
                       .where(F.col("score") >= MIN_SCORE).select("kind", "instance", "shape"), "fresh")
        shapes = staged(seeds.unionByName(fresh).groupBy("kind", "shape")
                        .agg(F.countDistinct("instance").alias("m"))
                        .where(F.col("m") >= MIN_SUPPORT).select("kind", "shape"), "shapes")
        known = staged(seeds.select("kind", "instance").unionByName(
            fresh.join(shapes, ["kind", "shape"]).select("kind", "instance")).distinct(), "instances")
    return accepted.join(shapes, "kind").select("kind", "pattern", "shape", "confidence")


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``spans`` (base, kind number) and ``added`` (start, end, kind
    number that the pattern stands for, ``SECRET`` one of them) for every row."""
    found = staged(scan_documents(df, id_col, text_col), "scan")
    each = (found.select("key", F.explode("mentions").alias("m")).select("key", "m.*")
            .withColumn("pattern", F.explode("patterns")).drop("patterns"))
    edges = staged(each.groupBy("kind", "instance", "pattern", "shape").agg(F.count("*").alias("n")), "edges")
    accepted = bootstrap(edges)
    added = (each.where((F.col("kind") < 0) | (F.col("kind") == SECRET)).drop("kind").join(accepted, ["pattern", "shape"])
             .groupBy("key", "start", "end")
             .agg((-F.max(F.struct("confidence", (-F.col("kind")).alias("k")))["k"]).alias("kind"))
             .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("added")))
    none = F.array().cast("array<struct<start:long,end:long,kind:int>>")
    return (found.drop("mentions").join(added, "key", "left")
            .select("doc_id", "spans", F.coalesce("added", none).alias("added")))


def span_texts(spans: str, kind: str) -> Column:
    """``kind:start:end`` of an array of spans."""
    return F.transform(F.col(spans), lambda s: F.concat_ws(
        ":", F.get(F.array(*map(F.lit, KINDS)), s["kind"]) if kind == "" else F.lit(kind),
        s["start"].cast("string"), s["end"].cast("string")))


def count_of(kind: int) -> Column:
    """Base spans of a kind number."""
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
