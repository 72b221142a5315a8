"""URL rules by host-suffix / path-prefix expressions and hash prefixes.

A rule is ``(host, path, action)``. It fits its host and every subdomain when
the URL's path starts with the rule's path. A URL is expanded into every
``host suffix + path prefix`` expression that a rule could have: the label
counts and path lengths that occur among the rules bound the expansion. The
expressions meet the rules in an equi-join on the first digits of their
SHA-256 digest, and the full digest confirms a hit. The longest fitting rule
wins; among equally long rules the one with the longer host, then ``block``.

Only distinct (host, path) pairs are expanded, so a URL that makes up a third
of all rows is judged once; the verdicts join back on the pair, where adaptive
execution may split a hot pair (no side is forced to be broadcast).

Defined results: a null URL or one without ``://`` has host and path ``""``;
no fitting rule gives the default action and a null rule; repeated rows give
repeated results; an empty rule table gives the default everywhere; columns of
the input other than ``url`` pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: Hexadecimal digits of the short hash that the join uses (32 bits).
PREFIX_DIGITS = 8


def url_host(url: Column) -> Column:
    host = F.regexp_extract(url, URL_PARTS, 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``(action, host, path)`` triples as a rule table."""
    return spark.createDataFrame(rules, "action string, host string, path string")


def _indexed(rules: DataFrame) -> DataFrame:
    """Rules with digest and precedence; one row per expression, ``block`` first."""
    expr = F.concat("host", "path")
    return (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
            .select(F.sha2(expr, 256).alias("r_digest"), expr.alias("r_rule"),
                    F.length("host").alias("r_host"), "action")
            .groupBy("r_digest", "r_rule", "r_host")
            .agg(F.max(F.col("action") == "block").alias("r_block"),
                 F.min("action").alias("r_action"))
            .withColumn("r_prefix", F.substring("r_digest", 1, PREFIX_DIGITS)))


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url",
               default: str = "allow") -> DataFrame:
    """``df`` with columns ``host``, ``path``, ``rule``, ``verdict`` (replacing
    columns of those names)."""
    shapes = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).select(
        F.size(F.split("host", r"\.", -1)).alias("labels"), F.length("path").alias("chars"))
    # distinct label counts and path lengths: bounded by the longest host and path of a rule
    labels = [r[0] for r in shapes.select("labels").distinct().collect()]
    chars = [r[0] for r in shapes.select("chars").distinct().collect()]
    keep = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    own = [f"c{k}" for k in range(len(keep))]           # no name of the input meets one used here
    numbered = df.toDF(*(f"in{k}" for k in range(len(df.columns))))
    at = {c: F.col(f"in{k}") for k, c in enumerate(df.columns)}
    pages = numbered.select(*(at[c].alias(o) for c, o in zip(keep, own)),
                            url_host(at[url]).alias("host"), url_path(at[url]).alias("path"))

    parts = F.split("host", r"\.", -1)
    ints = "array<int>"
    suffixes = F.transform(
        F.filter(F.lit(labels).cast(ints), lambda n: n <= F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    prefixes = F.transform(
        F.filter(F.lit(chars).cast(ints), lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n))
    wanted = (pages.select("host", "path").distinct()
              .withColumn("suffix", F.explode(suffixes))
              .withColumn("lead", F.explode(prefixes))
              .withColumn("digest", F.sha2(F.concat("suffix", "lead"), 256))
              .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS)))
    index = _indexed(rules)
    hits = (wanted.join(index, (F.col("prefix") == F.col("r_prefix"))
                        & (F.col("digest") == F.col("r_digest")))
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("r_rule"), "r_host", "r_block", "r_rule", "r_action"))
                 .alias("best"))
            .select(F.col("host").alias("h"), F.col("path").alias("p"),
                    F.col("best.r_rule").alias("rule"),
                    F.when(F.col("best.r_block"), F.lit("block"))
                    .otherwise(F.col("best.r_action")).alias("verdict")))
    return (pages.join(hits, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
            .select(*own, "host", "path", "rule",
                    F.coalesce("verdict", F.lit(default)).alias("verdict"))
            .toDF(*keep, "host", "path", "rule", "verdict"))
