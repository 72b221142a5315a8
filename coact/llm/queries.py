"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coact.session import scratch_dir

from . import (
    align, decontam, exact_dedup, hard_negatives, language_id, line_dedup, minhash, packing, pii,
    quality_knn, quality_rules, rans, url_filter)
from .common import held_out, prepare, table

#: The rules of the URL query: action, host, path.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = quality_rules.apply_quality_rules(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "rule", "rule_text")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = (table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
            .withColumn("held_out", held_out(F.col("doc_id"), 3, 1)))
    train = docs.where(~F.col("held_out"))
    profiles = language_id.learn_profiles(train, F.col("text"), F.col("lang"))
    return language_id.predict_language(docs, F.col("text"), ["doc_id", "held_out"], profiles)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = (table(spark, sf_dir, "documents").select("doc_id", "text")
            .withColumn("held_out", held_out(F.col("doc_id"), 4, 2)))
    model = quality_knn.learn(docs.where(~F.col("held_out")), table(spark, sf_dir, "labels"),
                              F.col("text"), F.col("doc_id"))
    return (quality_knn.score(docs, F.col("text"), ["doc_id", "held_out"], model)
            .withColumn("predicted", (F.col("score") >= quality_knn.THRESHOLD).cast("int")))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "n_lines_removed")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = url_filter.rules_frame(spark, URL_RULES)
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = scratch_dir(spark, "llm-tokens")
    rans.write_tokens(table(spark, sf_dir, "documents"), path)
    return rans.read_tokens(spark, path)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    counts = [pii.count_of(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    base, added = pii.span_texts("spans", ""), pii.span_texts("added", pii.METHOD)
    return found.select(
        "doc_id", *counts, F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, added), ",").alias("spans"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.find_copies(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return align.align_corpus(table(spark, sf_dir, "documents"))


REGISTRY = {
    "op1_quality_rules": op1_quality_rules,
    "op2_language_id": op2_language_id,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_line_dedup": op4_line_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_url_filters": op8_url_filters,
    "op9_token_files": op9_token_files,
    "op10_pii": op10_pii,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_alignment": op13_token_alignment,
}

SQL = {
    "op8_url_filters": r"""
WITH pages_split AS (
  SELECT page_id,
         CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
              ELSE translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS host,
         CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
              ELSE regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) END AS path
  FROM pages),
rules(action, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
judged AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM pages_split) u
  JOIN rules r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p)
  GROUP BY host, path)
SELECT s.page_id, s.host, s.path, j.rule, coalesce(j.verdict, 'allow') AS verdict
FROM pages_split s LEFT JOIN judged j ON s.host = j.host AND s.path = j.path
""",
    "op11_exact_dedup": r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
ranked AS (
  SELECT doc_id, t, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS n,
         count(*) OVER (PARTITION BY t) AS group_size
  FROM texts WINDOW w AS (PARTITION BY t ORDER BY doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, n = 1 AS kept, sha256(t) AS text_sha256 FROM ranked
""",
    "op12_hard_negatives": """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s
  ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
""",
}
