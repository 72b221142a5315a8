"""Exact dedup by the extendible-hash index, hard-negative mining and
cross-tokenizer alignment against brute force, with their edge cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from coact.llm import align, exact_dedup, hard_negatives
from coact.llm.common import prepare
from coact.session import scratch_dir


@pytest.fixture(autouse=True)
def _prepared(spark):
    prepare(spark)


# --- exact dedup ---------------------------------------------------------------

def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute_copies(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(norm(t), []).append((i is None, i or 0, k))
    out = []
    for k, (i, t) in enumerate(rows):
        g = groups[norm(t)]
        least = min(g)
        out.append((i, None if least[0] else least[1], len(g), hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr), {key: min(g)[:2] for key, g in groups.items()}


def test_normalised_is_the_pattern():
    rng = random.Random(1)
    for _ in range(500):
        t = "".join(rng.choice(["a", "b ", " ", "\t", "\n", "\x0b", "\x0c", "\r", "é", " ", "\x1c", " "])
                    for _ in range(rng.randint(0, 12)))
        assert exact_dedup.normalised(t) == norm(t).encode()
    assert exact_dedup.normalised(None) == b""


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(7)
    rows = [(k, " ".join(rng.choice("ab cd ef gh".split()) for _ in range(rng.randint(1, 3)))) for k in range(120)]
    rows += [(200 + k, "one hot text\n" if k % 2 else "one  hot text ") for k in range(60)]
    rows += [(300, None), (301, ""), (302, "  "), (303, " "), (304, "x " * 30000), (305, "x  " * 30000),
             (306, "y" * 9), (306, "y" * 9), (306, "y" * 9), (None, "y" * 9), (None, "only null"), (None, "only  null")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [
    {}, {"bits": 2, "capacity": 3, "max_depth": 6}, {"bits": 3, "capacity": 2, "floor": 4}, {"capacity": 1, "floor": 1}])
def test_copies_brute(spark, copies, options):
    docs = spark.createDataFrame(copies, "doc_id long, text string").repartition(6)
    for clash in ("h", "link", "dk", "group_size"):
        docs = docs.withColumn(clash, F.lit("clash"))
    got = exact_dedup.find_copies(docs, **options).collect()
    want, least = brute_copies(copies)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert len(kept) == len(least) and set(kept.values()) == {1}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_copies_empty_and_string_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.find_copies(none).count() == 0
    named = spark.createDataFrame([("b", "t  t"), ("a", "t t"), ("c", "u")], "key string, body string")
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.find_copies(named, "key", "body").collect()}
    assert got == {"a": ("a", True), "b": ("a", False), "c": ("c", True)}


def test_directory_doubles_and_index_finds(spark):
    rng = random.Random(3)
    hashes = [rng.getrandbits(64) - (1 << 63) for _ in range(3000)]
    entries = spark.createDataFrame([(h,) for h in hashes] + [(hashes[0],)] * 4, "h long")
    path = scratch_dir(spark, "test-index")
    index = exact_dedup.Index.build(entries, path, capacity=64)
    d = index.directory
    assert len(d.bucket_of) == 1 << d.depth and sum(n for *_, n in d.buckets) == 3000
    assert max(n for *_, n in d.buckets) <= 64
    assert (np.diff(d.bucket_of) >= 0).all() and (np.diff(d.owner_of) >= 0).all()
    for r in index.buckets().collect():
        prefix, depth, _ = d.buckets[r.bucket]
        assert (r.h % (1 << 64)) >> (64 - depth) == prefix
    asked = spark.createDataFrame([(hashes[0],), (hashes[7],), (12345,)], "h long")
    assert {(r.h, r.rows) for r in index.lookup(asked).collect()} == {(hashes[0], 5), (hashes[7], 1)}
    # keys that no bit can part stay together in a chained bucket
    same = spark.createDataFrame([(h & ~0xFFFFFFFFFFF,) for h in range(200)], "h long")
    assert exact_dedup.grow_directory(same.distinct(), capacity=1, max_depth=5).depth <= 5
    stuck = exact_dedup.grow_directory(entries.distinct(), capacity=1, max_depth=4)
    assert stuck.depth == 4 and sum(n for *_, n in stuck.buckets) == 3000


# --- hard negatives --------------------------------------------------------------

def brute_negatives(rows, every=100):
    good = []
    for i, v, y in rows:
        if y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        y = (y + 1) % 10 if i is not None and i % 7 == 0 else y
        good.append((i, y, [math.floor(256 * float(x)) for x in v]))
    big = 1 << 62
    out = []
    anchors = {(i, y, tuple(q)) for i, y, q in good if i is not None and i % every == 0}
    for i, y, q in anchors:
        scored = sorted(((-sum(a * b for a, b in zip(q, p)), big if j is None else j, z) for j, z, p in good if j != i),
                        key=lambda s: s[:2])
        for s, j, _ in [x for x in scored if x[2] == y][:5]:
            hard = [x for x in scored if x[2] != y and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(i, None if j == big else j, k + 1, None if n == big else n, -s, -t) for k, (t, n, _) in enumerate(hard)]
    return Counter(out)


def mined(df, **options):
    return Counter(tuple(r) for r in hard_negatives.mine(df, **options).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


VECS = "vec_id long, embedding array<float>, label int"


def f32(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]


def test_negatives_brute(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = []
    for k in range(700):
        v = centres[k % 6] + rng.normal(size=8) * (0.05 if k % 3 else 1.0)
        rows.append((k, list(v / np.linalg.norm(v)), int(rng.integers(0, 10))))
    rows += [(1000 + k, rows[100][1], k % 3) for k in range(40)]                 # ties of one vector
    rows += [(800, None, 1), (900, [0.5] * 8, None), (1100, [0.5, None] + [0.0] * 6, 1),
             (1200, [float("nan")] + [0.1] * 7, 1), (1300, [float("inf")] + [0.1] * 7, 1),
             (1400, [0.0] * 8, 2), (1500, [0.3, 0.2], 3), (1600, [], 4), (None, rows[100][1], 0),
             (200, rows[300][1], 5), (200, rows[200][1], rows[200][2]), (1700, [-1.0] * 8, 6)]
    rows = f32(rows)
    df = spark.createDataFrame(rows, VECS).repartition(5)
    want = brute_negatives(rows)
    assert len(want) > 100
    for clash in ("score", "anchor", "w", "ref"):
        df = df.withColumn(clash, F.lit("clash"))
    assert mined(df) == want


def test_negatives_chunks_large_values_and_empty(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = f32([(k, list(rng.normal(size=4) * 2.0 ** rng.integers(0, 20)), int(k % 3)) for k in range(300)])
    df = spark.createDataFrame(rows, VECS)
    want = brute_negatives(rows, every=10)
    monkeypatch.setattr(hard_negatives, "CHUNK", 16)        # several chunks
    assert mined(df, every=10) == want
    wide = f32([(k, [1e30 * (k % 5 + 1), 2.0], k % 2) for k in range(200)])
    assert hard_negatives.mine(spark.createDataFrame(wide, VECS)).count() >= 0
    assert hard_negatives.mine(df.limit(0)).count() == 0
    one = spark.createDataFrame([(100, [1.0, 0.0], 1)], VECS)
    assert hard_negatives.mine(one).count() == 0


def test_bounds_hold_and_prune(spark):
    rng = np.random.default_rng(8)
    q = hard_negatives.quantised((rng.normal(size=(400, 12)) * rng.choice([0.01, 1, 50], size=(400, 1))).tolist(), 12)
    directions = hard_negatives.fit_directions(q[:100])
    norms, angles = hard_negatives.angles_to(q, directions)
    lo, hi = hard_negatives.score_bounds(*hard_negatives.cosine_bounds(angles[:50], angles, angles),
                                         norms[:50], norms, norms)
    exact = hard_negatives.exact_scores(q, q[:50])
    assert (exact == np.array([[sum(int(a) * int(b) for a, b in zip(x, y)) for y in q[:50]] for x in q])).all()
    assert (lo <= exact).all() and (exact <= hi).all()
    # tight clusters: most pairs are never scored
    centres = rng.normal(size=(16, 12))
    rows = [(k, (centres[k % 16] + rng.normal(size=12) * 0.01).tolist(), k % 16 % 10) for k in range(3000)]
    scored = spark.sparkContext.accumulator(0)
    hard_negatives.mine(spark.createDataFrame(rows, VECS).repartition(3), scored=scored).count()
    assert 0 < scored.value < 2 * 30 * 3000 // 3


# --- alignment ---------------------------------------------------------------------

def brute_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    path_a, path_b = align.default_paths()
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    letters = align._byte_letters()
    docs, counts = [], Counter()
    for t in texts:
        doc = ([], [], [], [], "")
        if t:
            x = a.encode(" " + t, add_special_tokens=False).ids
            y = b.encode(t)
            bx = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
            by = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()
                  for p in map(b.id_to_piece, y)]
            if b"".join(bx) == b"".join(by) == (" " + t).encode():
                ex, ey, links, groups = np.cumsum(list(map(len, bx))), np.cumsum(list(map(len, by))), [], []
                at = {int(e): k for k, e in enumerate(ey)}
                p = q = 0
                for k, e in enumerate(ex):
                    if int(e) in at:
                        m = at[int(e)]
                        links.append((x[k], y[m]))
                        groups.append(",".join(map(str, x[p:k + 1])) + "|" + ",".join(map(str, y[q:m + 1])))
                        p, q = k + 1, m + 1
                doc = (x, y, links, groups, hashlib.sha256(";".join(groups).encode()).hexdigest())
        docs.append(doc)
        counts.update(doc[2])
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(len(x), len(y), len(g), len(links), sum(counts[e] == best[e[1]] for e in links),
             sum(counts[e] for e in links), h) for x, y, links, g, h in docs]


TEXTS = ["The quick brown fox, 12 345!", "naïve café — “quoted” ﬁ ½", None, "", " lead and trail ", "a  b\n\nc\td",
         "<s> </s> <unk> <|endoftext|> <0x41>", "under ▁ score", "  \x1c", "日本語 русский العربية 🙂🙂",
         "repeat repeat repeat", "repeat repeat repeat", "x" * 5000, "\x00 nul", "é combining", "﻿bom", " ", "\n"]


@pytest.mark.parametrize("most", [align.SLICE, 40])
def test_alignment_brute(spark, monkeypatch, most):
    rng = random.Random(4)
    words = [w for t in TEXTS if t for w in t.split()]
    texts = TEXTS + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    if most < align.SLICE:
        monkeypatch.setattr(align, "SHARD", 16)     # many shards, several slices
        monkeypatch.setattr(align, "PAGE", 8)
        monkeypatch.setattr(align, "FAN", 2)
    for clash in ("a", "b", "n_a", "pair"):
        df = df.withColumn(clash, F.lit("clash"))
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
           for r in align.align_corpus(df, most=most).collect()}
    want = brute_alignment(texts)
    assert [got[k] for k in range(len(texts))] == want
    assert sum(w[0] > 0 for w in want) > 30


def test_alignment_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert align.align_corpus(df).count() == 0
    blank = spark.createDataFrame([(1, None), (1, None), (None, "")], "doc_id long, text string")
    assert {tuple(r)[1:] for r in align.align_corpus(blank).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_minimal_perfect_hash():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 50, 20000):
        keys = np.unique(rng.integers(0, 1 << 48, n))
        levels = align.build_hash(keys)
        assert sorted(align.find_hash(levels, keys).tolist()) == list(range(len(keys)))
        order = np.empty(len(keys), np.int64)
        order[align.find_hash(levels, keys)] = keys
        own = align.HashSlice(1, {0: levels}, {0: 0}, order)
        others = np.setdiff1d(rng.integers(0, 1 << 48, 100), keys)
        assert (own.find(others) == -1).all() and (order[own.find(keys)] == keys).all()


def test_links_share_ends():
    cuts, p, q = align.align(np.array([2, 2, 5, 7]), np.array([2, 4, 5, 5, 7]))
    assert cuts.tolist() == [2, 5, 7]
    assert list(zip(p.tolist(), q.tolist())) == [(0, 0), (1, 0), (2, 2), (2, 3), (3, 4)]
