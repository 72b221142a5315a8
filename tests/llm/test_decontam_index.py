"""BM25 index of the benchmark: statistics over all items, skipped postings, short items, punctuation words."""

import random

import numpy as np
import pytest

from coact.llm import decontam
from coact.llm.common import prepare

DOCS = "doc_id long, text string"


@pytest.fixture(autouse=True)
def _prepared(spark):
    prepare(spark)


def prose(rng, n, syllables="ba de ki lo mu ra se ti vo zu".split()):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_scores_do_not_depend_on_the_number_of_indexes(spark, monkeypatch):
    rng = random.Random(21)
    items = [(k, prose(rng, rng.randint(9, 60)) + ". " + prose(rng, 4)) for k in range(90)]
    items += [(100, "short one item"), (101, None), (102, "  "), (103, items[0][1])]
    docs = [(k, prose(rng, 200) + " " + items[rng.randrange(90)][1] + " " + prose(rng, 200)) for k in range(25)]
    docs += [(50, "a short, one item!"), (51, items[0][1]), (52, None), (53, "")]
    df, tests = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(tuple(r) for r in decontam.find_leaks(df, tests).collect())
    monkeypatch.setattr(decontam, "INDEX_CHARS", 3000)
    built = list(decontam.indexes(tests, decontam.THRESHOLD))
    assert len(built) > 3 and len({b.value.stride for b in built}) == 1
    many = sorted(tuple(r) for r in decontam.find_leaks(df, tests).collect())
    assert [r[:2] for r in one] == [r[:2] for r in many] and np.allclose([r[2] for r in one], [r[2] for r in many])
    assert (50, 100, 1.0, 1.0, 1.0) in one and {(51, 0), (51, 103)} <= {r[:2] for r in one}
    assert {r[0] for r in one} == {*range(25), 50, 51}
    assert decontam.drop_contaminated(df, tests).count() == 2


def test_index_by_brute_force():
    """Impacts are BM25 shares; every term's entries and postings stand where the offsets say."""
    rng = random.Random(22)
    items = [(k, prose(rng, rng.randint(8, 40))) for k in range(150)]
    index = decontam.Index(items)
    words = [decontam.normal_words(t) for _, t in items]
    mean = sum(map(len, words)) / len(words)
    for w, t in index.terms.items():
        n = sum(w in own for own in words)
        idf = np.log(1 + (150 - n + 0.5) / (n + 0.5))
        own = {int(index.item[p]): index.impact[p] for p in range(index.begin[t], index.begin[t + 1])}
        assert own.keys() == {k for k, x in enumerate(words) if w in x}
        best = {}
        for e in range(index.block_begin[t], index.block_begin[t + 1]):
            span = range(index.entry_begin[e], index.entry_begin[e + 1])
            assert {int(index.item[p]) // decontam.BLOCK_ITEMS for p in span} == {int(index.block[e])}
            best[int(index.block[e])] = max(index.impact[p] for p in span)
            assert best[int(index.block[e])] == index.block_max[e]
        assert best.keys() == {k // decontam.BLOCK_ITEMS for k in own} and max(best.values()) == index.most[t]
        for k, x in own.items():
            score = {}
            for v in set(words[k]):
                m = sum(v in other for other in words)
                tf = words[k].count(v)
                score[v] = (np.log(1 + (150 - m + 0.5) / (m + 0.5)) * tf * (decontam.K1 + 1)
                            / (tf + decontam.K1 * (1 - decontam.B + decontam.B * len(words[k]) / mean)))
            assert np.isclose(x, score[w] / sum(score.values())) and idf > 0
            break


def test_closed_blocks_are_skipped(monkeypatch):
    rng = random.Random(23)
    index = decontam.Index([(k, prose(rng, 20)) for k in range(640)])
    terms = np.unique([index.terms[w] for w in decontam.normal_words(prose(random.Random(23), 20))])
    gathered = []
    real = decontam.Index._spans

    def spy(begin, at):
        out = real(begin, at)
        gathered.append(len(out))
        return out

    monkeypatch.setattr(decontam.Index, "_spans", staticmethod(spy))
    assert [k for k, _ in index.above(terms, 0.9)] == [0]
    assert gathered[-1] < sum(index.begin[t + 1] - index.begin[t] for t in terms) / 4


def test_short_items_match_in_a_row_only(spark):
    tests = spark.createDataFrame([(1, "Alpha beta. Gamma"), (2, "Alpha beta. Gamma"), (3, "one"), (4, "delta delta"),
                                   (5, "alpha beta delta")], "item_id long, text string")
    rows = [(0, "x alpha ... beta, (gamma) y"), (1, "alpha beta x gamma"), (2, "one"), (3, "delta"),
            (4, "delta delta delta"), (5, "alpha beta"), (6, "alpha beta delta"), (7, "... !!"), (8, None)]
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(spark.createDataFrame(rows, DOCS), tests).collect()}
    assert got == {(0, 1), (0, 2), (4, 4), (6, 5)}


def test_punctuation_words_do_not_hide_an_item(spark):
    rng = random.Random(24)
    item = prose(rng, 60) + ". " + prose(rng, 5)
    spaced = " ... ".join(item.split())
    fill = prose(rng, 400, "pha cho sku wre".split()).split()
    rows = [(k, " - ".join(fill[:k]) + " " + spaced + " " + " ".join(fill[k:])) for k in range(0, 330, 3)]
    found = decontam.find_leaks(spark.createDataFrame(rows, DOCS),
                                spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert {r.doc_id for r in found} == {k for k, _ in rows}
    # each occurrence lies whole in one of the passages
    index = decontam.Index([(7, item)])
    assert all(any(hit[2:] == (1.0, 1.0) for hit in index.verified(text)) for _, text in rows)
