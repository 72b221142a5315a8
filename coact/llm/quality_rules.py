"""Learned decision lists over document statistics.

1. One pass over the whole texts computes the statistics of every document in
   Arrow batches (``document_statistics``); only those narrow rows are kept.
2. ``learn_rules`` grows an ordered list of threshold conjunctions by
   sequential covering. A growth step is one Spark aggregation: the labelled
   rows that the rule still covers are counted by (statistic, bin, label), at
   most ``statistics x (BINS + 1) x 2`` cells, and the driver picks the
   condition with the best FOIL gain from these counts. Every labelled row
   takes part, there is no sample.
3. A finished rule is pruned on rows that did not grow it: the prefix of its
   conditions with the best (p - n) / (p + n) stays. It is kept if its
   precision there reaches ``min_precision``; otherwise the list ends. An
   "above" threshold then moves half way to the nearest covered row.
4. ``decision_column`` writes the list as one ordered Spark conditional
   (``when(...).when(...).otherwise(...)``).

Defined results: a null or empty text has zero words and fails the base rule;
labels repeated for an id count once, with the lowest quality; without labels
of both classes the list is empty and only the base rule decides; repeated
rows each get their own result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, staged

WINDOW = 8           # words in a repeated window
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30   # base rule

BINS = 32            # thresholds tried per statistic
MAX_RULES, MAX_CONDITIONS = 12, 4
MIN_COVER = 4        # rejected rows that a rule must cover on the pruning fold
MIN_PRECISION = 0.9

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_chars", "n_lines", "n_distinct_words", "n_digits", "n_upper",
          "n_odd_words", "n_adjacent", "n_stops"]
STAT_FIELDS = [T.StructField(c, T.LongType()) for c in COUNTS]


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more. Windows are named exactly
    by doubling (pairs of names), not by a hash."""
    n = len(ids)
    if n <= window:
        return 0
    names, width = ids, 1
    while width < window:
        step = min(width, window - width)
        left, right = names[:len(names) - step], names[step:]
        _, names = np.unique(left * np.int64(n + 1) + right, return_inverse=True)
        width += step
    times = np.bincount(names)
    found = times[names] > 1
    if not found.any():
        return 0
    edge = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(found)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    words = raw.split()          # ASCII white space, as the word rule says
    n = len(words)
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    codes = np.frombuffer(raw, np.uint8)
    odd = sum(1 for w in names if not w.strip(b".,;:!?'\"()-").isalpha() and w.isascii())
    return (n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(ids), len(text), len(lines),
            len(names), int(((codes >= 48) & (codes <= 57)).sum()),
            int(((codes >= 65) & (codes <= 90)).sum()), odd,
            int((ids[1:] == ids[:-1]).sum()), text.count(". ") + text.count(".\n"))


def append_statistics(df: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``df`` and ``COUNTS`` for every row, from its whole text."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.array([text_counts(t) for t in b.column(0).to_pylist()], np.int64)
            rows = rows.reshape(b.num_rows, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], *(pa.array(rows[:, k]) for k in range(len(COUNTS)))],
                [*keep, *COUNTS])

    kept = df.select(*keep)
    return (df.select(text.alias("_text"), *keep)
            .mapInArrow(counted, T.StructType([*kept.schema.fields, *STAT_FIELDS])))


def document_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``COUNTS`` for every row."""
    own = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
    return append_statistics(own, F.col("_t"), ["doc_id"])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | \
        (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def statistic_columns() -> dict[str, Column]:
    """The interpretable ratios that conditions are made of."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    ratios = {
        "words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / lines,
        "repeat_share": F.col("n_repeat_words") / words,
        "distinct_share": F.col("n_distinct_words") / words,
        "digit_share": F.col("n_digits") / chars,
        "upper_share": F.col("n_upper") / chars,
        "odd_share": F.col("n_odd_words") / words,
        "adjacent_share": F.col("n_adjacent") / words,
        "words_per_line": words / lines,
        "stops_per_word": F.col("n_stops") / words,
    }
    return {k: F.round(v, 6) for k, v in ratios.items()}


Condition = tuple[str, str, float]     # statistic, ">" or "<=", threshold


def condition_column(conditions: list[Condition]) -> Column:
    columns, out = statistic_columns(), F.lit(True)
    for name, sign, value in conditions:
        out = out & ((columns[name] > F.lit(value)) if sign == ">" else (columns[name] <= F.lit(value)))
    return out


def decision_column(rules: list[list[Condition]]) -> Column:
    """The first rule that holds, from 1; null if none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        hit = condition_column(rule)
        out = F.when(hit, F.lit(k)) if out is None else out.when(hit, F.lit(k))
    return F.lit(None).cast("int") if out is None else out


def rule_text(rule: list[Condition]) -> str:
    return " and ".join(f"{a} {b} {c:g}" for a, b, c in rule)


def _bin(value: Column, points: list[float]) -> Column:
    """How many cut points lie below the value."""
    return F.size(F.filter(F.lit(points).cast("array<double>"), lambda t: t < value))


def _tests(bins: list[str], rule: list[tuple[int, str, int]]) -> Column:
    out = F.lit(True)
    for f, sign, b in rule:
        out = out & ((F.col(bins[f]) >= b) if sign == ">" else (F.col(bins[f]) < b))
    return out


def learn_rules(stats: DataFrame, labels: DataFrame, min_precision: float = MIN_PRECISION,
                max_rules: int = MAX_RULES) -> list[list[Condition]]:
    """Rules that reject, learned from the rows of ``stats`` that pass the base
    rule and have a label (``doc_id``, ``quality`` 0 or 1)."""
    spark, columns = stats.sparkSession, statistic_columns()
    names = list(columns)
    y = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
         .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    rows = (stats.where(~base_failed()).join(y, "doc_id")
            .select((F.col("quality") == 0).alias("bad"),
                    (crc_mod(F.concat_ws("/", F.lit("grow"), "doc_id"), 3) != 0).alias("grow"),
                    *(columns[n].alias(n) for n in names)))
    rows = staged(rows, "labelled")
    share = [k / BINS for k in range(1, BINS)]
    # cut points of both classes, so that a rare class gets thresholds of its own
    cuts = rows.groupBy("bad").agg(*(F.percentile_approx(n, share, 2000).alias(n) for n in names)).collect()
    if len(cuts) < 2:
        return []
    points = {n: sorted({v for r in cuts for v in r[n]}) for n in names}
    bins = [f"b{k}" for k in range(len(names))]
    rows = staged(rows.select(
        "bad", "grow", *names, *(_bin(F.col(n), points[n]).alias(b) for n, b in zip(names, bins))), "binned")
    # statistic value is above points[k] exactly if its bin is at least k + 1
    left, rules = rows, []
    while len(rules) < max_rules:
        rule: list[tuple[int, str, int]] = []
        grown = left.where("grow")
        while len(rule) < MAX_CONDITIONS:
            step = _best_condition(grown.where(_tests(bins, rule)), bins)
            if step is None or step[:3] in rule:
                break
            rule.append(step[:3])
            if step[3] == 0:      # covers rejected rows only
                break
        if not rule:
            break
        rule, p, n = _pruned(left.where(~F.col("grow")), bins, rule)
        if p < MIN_COVER or p < min_precision * (p + n):
            break
        rules.append(_centred(left.where(_tests(bins, rule)), names,
                              [(names[f], s, float(points[names[f]][b - 1])) for f, s, b in rule]))
        left = left.where(~_tests(bins, rule))
    return rules


def _best_condition(rows: DataFrame, bins: list[str]) -> tuple[int, str, int, int] | None:
    """(statistic, sign, bin, kept rows still covered) of the best FOIL gain."""
    cells = (rows.select("bad", F.posexplode(F.array(*bins)).alias("f", "b"))
             .groupBy("f", "b", "bad").count().collect())
    if not cells:
        return None
    top = max(c["b"] for c in cells) + 1
    counts = np.zeros((2, len(bins), top + 1))
    for c in cells:
        counts[int(c["bad"]), c["f"], c["b"]] += c["count"]
    n_all, p_all = counts[0, 0].sum(), counts[1, 0].sum()
    if p_all == 0 or n_all == 0:
        return None
    above = np.cumsum(counts[:, :, ::-1], axis=2)[:, :, ::-1]
    best, found = 1e-9, None
    start = math.log2(p_all / (p_all + n_all))
    for f in range(len(bins)):
        for b in range(1, top):
            n_up, p_up = above[0, f, b], above[1, f, b]
            for sign, p, n in ((">", p_up, n_up), ("<=", p_all - p_up, n_all - n_up)):
                if p >= MIN_COVER:
                    gain = p * (math.log2(p / (p + n)) - start)
                    if gain > best:
                        best, found = gain, (f, sign, b, int(n))
    return found


def _centred(covered: DataFrame, names: list[str], rule: list[Condition]) -> list[Condition]:
    """The rule with each "above" threshold half way to the nearest covered row,
    which covers the same labelled rows with more room for rows to be kept."""
    nearest = covered.agg(*(F.min(n).alias(n) for n in names)).first()
    return [(n, s, (t + nearest[n]) / 2 if s == ">" else t) for n, s, t in rule]


def _pruned(rows: DataFrame, bins: list[str], rule: list) -> tuple[list, int, int]:
    counts = []
    for k in range(1, len(rule) + 1):
        hit = _tests(bins, rule[:k])
        counts += [F.count_if(hit & F.col("bad")).alias(f"p{k}"),
                   F.count_if(hit & ~F.col("bad")).alias(f"n{k}")]
    r = rows.agg(*counts).first()
    worth = lambda k: (r[f"p{k}"] - r[f"n{k}"]) / max(1, r[f"p{k}"] + r[f"n{k}"])
    k = max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))
    return rule[:k], r[f"p{k}"], r[f"n{k}"]


def apply_quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of every row with ``base_failed``, ``rule`` (its number in the
    learned list or null), ``rule_text`` and ``kept``."""
    stats = staged(document_statistics(docs), "statistics")
    rules = learn_rules(stats, labels)
    texts = F.lit([rule_text(r) for r in rules] or [""]).cast("array<string>")
    return (stats.withColumn("base_failed", base_failed())
            .withColumn("rule", F.when(~F.col("base_failed"), decision_column(rules)))
            .withColumn("rule_text", F.get(texts, F.col("rule") - 1))
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))


def keep_good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the learned list keeps, with their own columns.

    The rules are learned from the narrow statistics; the documents then pass a
    second time with their statistics beside them, so that no text is shuffled.
    """
    rules = learn_rules(staged(document_statistics(docs), "statistics"), labels)
    own = [f"c{k}" for k in range(len(docs.columns))]      # clear of the statistics' names
    wide = append_statistics(docs.toDF(*own), F.col(own[docs.columns.index("text")]), own)
    return (wide.where(~base_failed() & decision_column(rules).isNull())
            .select(*own).toDF(*docs.columns))
