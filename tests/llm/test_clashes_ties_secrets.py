"""Clashing column names, ties, long and empty inputs; secrets found by their context."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from coact.llm import line_dedup, pii, quality_knn, url_filter
from coact.llm.common import prepare


@pytest.fixture(autouse=True)
def _prepared(spark):
    prepare(spark)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


# --- URL filters -----------------------------------------------------------

RULES = [("allow", "org", "/"), ("block", "a.org", "/"), ("allow", "a.org", "/"), ("block", "b.a.org", ""),
         ("allow", "c.org", "/xy"), ("block", "d.c.org", "/")]


def url_brute(host, path):
    fits = [(len(h + p), len(h), a == "block", h + p, a) for a, h, p in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else (None, "allow")


def test_url_columns_may_have_any_name(spark):
    urls = ["http://x.ORG/", "http://a.org/q", "http://b.a.org/", "http://d.c.org/xy", "http://e.c.org/xyz", None, "no"]
    names = ["h", "p", "url", "digest", "suffix", "r_rule", "c0", "in2", "best", "host"]
    rows = [(f"h{k}", k, u, *["z"] * 7) for k, u in enumerate(urls)] * 2
    schema = ", ".join(f"{n} {'int' if n == 'p' else 'string'}" for n in names)
    out = url_filter.judge_urls(spark.createDataFrame(rows, schema), url_filter.rules_frame(spark, RULES))
    assert out.columns == [*names[:-1], "host", "path", "rule", "verdict"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["h"], r["url"]) == (f"h{r['p']}", urls[r["p"]]) and r["c0"] == r["in2"] == "z"
        assert (r["rule"], r["verdict"]) == url_brute(r["host"], r["path"])


def test_equally_long_rules_and_no_pages(spark):
    rules = url_filter.rules_frame(spark, [("allow", "a.org", "/x"), ("block", "a.org", "/x"), ("block", "org", "/")])
    page = spark.createDataFrame([("http://a.org/x",)], "url string")
    assert [tuple(r)[-2:] for r in url_filter.judge_urls(page, rules).collect()] == [("a.org/x", "block")]
    assert url_filter.judge_urls(page.limit(0), rules).count() == 0


# --- line dedup --------------------------------------------------------------

def test_line_dedup_with_clashing_columns_and_a_long_text(spark):
    import corpus_pipeline
    run = "\n".join(f"line {k} of a run that two documents share" for k in range(4))
    long = "\n".join(f"own line number {k} here" for k in range(20_000))
    rows = [(1, run, 10, 7, "a"), (2, f"head\n{run}\ntail", 20, 8, "b"), (3, f"{long}\n{run}", 30, 9, "c"),
            (4, "", 0, 0, "d"), (5, None, 0, 0, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, n_lines_removed int, gone string")
    out = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert {k: r.n_lines_removed for k, r in out.items()} == {1: 0, 2: 4, 3: 4, 4: 0, 5: 0}
    assert (out[2].text, out[3].text, out[5].text) == ("head\ntail", long, None) and out[3].gone == "c"
    staged = corpus_pipeline.lines(spark, docs, "")
    assert staged.columns == docs.columns
    assert {r.doc_id: r.n_lines_removed for r in staged.collect()} == {1: 7, 2: 8, 3: 9, 4: 0, 5: 0}


# --- nearest neighbours --------------------------------------------------------

def test_equal_cosines_go_to_the_smaller_position():
    rng = np.random.default_rng(2)
    for k in (1, 4, 9, 30):
        near = rng.integers(0, 6, (200, 30)).astype(np.float32) / 8
        got = np.sort(quality_knn.nearest(near, k), axis=1)
        assert np.array_equal(got, np.sort(np.argsort(-near, axis=1, kind="stable")[:, :k], axis=1))


# --- personal data ---------------------------------------------------------------

def hexa(rng, n=40):
    return "a1" + "".join(rng.choice("0123456789abcdef") for _ in range(n - 2))


def test_secrets_are_found_in_a_context_and_left_alone_without(spark):
    rng = random.Random(21)

    def word():
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))

    keys = [hexa(rng) for _ in range(30)]
    rows = [(k, f'{word()} {word()} token = "{x}" {word()}', "en") for k, x in enumerate(keys)]
    rows[3] = (3, rows[3][1].replace('" ', '"### '), "en")       # marks may touch the closing quote
    rows += [(100 + k, f"{word()} {hexa(rng)} {word()}", "en") for k in range(30)]         # no context repeats
    out = {r.doc_id: r for r in pii.find_personal_data(frame(spark, rows)).collect()}
    for k, x in enumerate(keys):
        at = rows[k][1].index(x)
        assert [(a.start, a.end) for a in out[k].added] == [(at, at + 40)]
    assert all(out[100 + k].added == [] for k in range(30))


def test_secret_forms():
    assert pii.is_secret("0123456789abcdef" * 2) and pii.is_secret("Ab3" * 11)
    assert not any(map(pii.is_secret, ["0" * 40, "a" * 40, "abc123", "0123456789abcdef", "https://a.b/" + "c1" * 20]))


def test_long_words_stay_apart_and_spans_do_not_overlap():
    assert pii._level("x" * 100 + "a") != pii._level("x" * 100 + "b")
    assert pii._shape("a-" * 60 + "1") != pii._shape("a-" * 60 + "b")
    cut = "w" * 1000 + " x12345 " + "v" * 1000
    assert pii.mentions(cut, [])[0][4] == ["^ ^ _ $"]               # neither neighbour lies whole in reach
    text = "10.0.0.1," * 12 + "z9z9z9 w"
    spans = pii.base_spans(text)
    assert len(spans) >= 12 and [m[0] for m in pii.mentions(text, spans)].count(-1) == 0


def test_personal_data_with_clashing_columns_and_long_text(spark):
    text = "word " * 60_000 + "mail a@b.co now"
    docs = spark.createDataFrame([(1, text, "x", "y"), (2, None, "x", "y"), (2, None, "x", "y")],
                                 "doc_id long, text string, key string, spans string")
    out = pii.find_personal_data(docs)
    assert out.count() == 3
    r = out.where(F.col("doc_id") == 1).first()
    assert [(s.kind, s.start, s.end) for s in r.spans] == [(0, 300_005, 300_011)] and r.added == []
