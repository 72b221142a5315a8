"""Line deduplication by a suffix structure over line-ID sequences.

Lines (without blank ones) of all documents form one sequence of line IDs,
128-bit hashes of the whole line. Distributed prefix doubling names the runs of
1, 2, 4, ... lines that start at each position: two positions have the same
name at a level exactly if their runs are equal, so the names of all levels
order the suffixes, and the positions with a common name are the interval of
suffixes with at least that common prefix. A name is the first position of its
interval. Only positions in intervals of two or more suffixes go on to the next
level; a run that no other position shares leaves the computation.

A repeated run counts from ``min_words`` words on. It has at most ``min_words``
non-blank lines until it gets there, so the doubling ends after
``log2(min_words)`` levels at any corpus size. For each position the shortest
run with so many words that starts there, and the one that ends there, are
named by two overlapping doubled runs. The qualifying runs that also occur
earlier cover the maximal repeated runs (every maximal repeat is the union of
the shortest runs inside it), and their lines are deleted: a line goes exactly
if it lies in a run of consecutive lines, ``min_words`` words long in total,
that also starts earlier, by doc_id, then text hash, then position.

DataFrame functions only. Groups are aggregated before they are joined, a line
that a third of all documents share is one row there, and the joins back are
equi-joins that adaptive execution may split. Long-lived steps are written to
the shared folder.

Defined results: a null text stays null, an empty one empty; blank lines are
never deleted nor counted, but a text whose other lines all go becomes empty;
rows equal in doc_id and text count as one document and get the same result;
ties cannot arise, positions are unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_key, staged

MIN_WORDS = 10


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, dk, line, pos, w, h1, h2): every non-blank line with its number in
    the text, its place among the non-blank lines, its words and its ID."""
    text = F.col(text_col)
    numbered = (docs.select(F.col(id_col).alias("id"), row_key(F.col(id_col), text).alias("dk"),
                            F.filter(F.transform(F.split(text, "\n", -1),
                                                 lambda x, i: F.struct(i.alias("line"), x.alias("x"))),
                                     lambda s: ~s["x"].rlike(r"^[\x20\x09-\x0D]*$")).alias("lines"))
                .select("id", "dk", F.posexplode("lines").alias("pos", "l")))
    line = F.col("l.x")
    return numbered.select(
        "id", "dk", F.col("l.line").alias("line"), "pos",
        F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")).alias("w"),
        F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("second"), line).alias("h2"))


def _named(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """``rows`` whose ``key`` occurs twice or more, with the first position that
    has it as ``name``."""
    place = F.struct("id", "dk", "pos")
    first = (rows.groupBy(*key).agg(F.min(place).alias(name), F.count("*").alias("times"))
             .where("times > 1").drop("times"))
    return rows.join(first, key)


def _at(name: str) -> list[Column]:
    """A name as plain columns, for joining on."""
    return [F.col(f"{name}.dk").alias(f"{name}_dk"), F.col(f"{name}.pos").alias(f"{name}_pos")]


def doubled_names(lines: DataFrame, min_words: int) -> list[DataFrame]:
    """Per level k, the positions whose run of 2**k lines is repeated:
    (id, dk, pos, n_dk, n_pos), n being the first position of the interval."""
    # rows equal in doc_id and text have the same positions: one of each stays
    named = _named(lines, ["h1", "h2"], "n").dropDuplicates(["dk", "pos"])
    levels = [staged(named.select("id", "dk", "pos", "line", "w", *_at("n")), "names0")]
    width = 1
    while 2 * width <= min_words:
        here = levels[-1].select("id", "dk", "pos", "n_dk", "n_pos")
        there = here.select("dk", (F.col("pos") - width).alias("pos"),
                            F.col("n_dk").alias("m_dk"), F.col("n_pos").alias("m_pos"))
        pairs = here.join(there, ["dk", "pos"])
        named = _named(pairs, ["n_dk", "n_pos", "m_dk", "m_pos"], "n")
        levels.append(staged(named.select("id", "dk", "pos", *_at("n")), f"names{len(levels)}"))
        width *= 2
    return levels


def _runs(first: DataFrame, min_words: int) -> DataFrame:
    """Shortest runs of ``min_words`` words among repeated lines, from each line
    on and up to each line: (id, dk, start, size)."""
    doc = Window.partitionBy("id", "dk").orderBy("pos")
    # a run stays inside consecutive repeated lines; min_words lines always suffice
    ahead = F.collect_list(F.struct("pos", "w")).over(doc.rowsBetween(0, min_words - 1))
    behind = F.collect_list(F.struct("pos", "w")).over(doc.rowsBetween(-(min_words - 1), 0))

    def size(near: Column, sign: int) -> Column:
        own = F.filter(near, lambda s: (s["pos"] - F.col("pos")) * sign < min_words)
        ordered = own if sign > 0 else F.reverse(own)
        # lines taken until the words suffice; a gap in the positions ends the run
        state = F.aggregate(
            ordered, F.struct(F.lit(0).alias("n"), F.lit(0).alias("w"), F.lit(True).alias("ok")),
            lambda a, s: F.when((a["w"] >= min_words) | ~a["ok"], a).otherwise(F.struct(
                (a["n"] + 1).alias("n"), (a["w"] + s["w"]).alias("w"),
                ((s["pos"] - F.col("pos")) * sign == a["n"]).alias("ok"))))
        return F.when(state["ok"] & (state["w"] >= min_words), state["n"])

    near = first.select("id", "dk", "pos", ahead.alias("ahead"), behind.alias("behind"))
    sized = near.select("id", "dk", "pos", size(F.col("ahead"), 1).alias("a"), size(F.col("behind"), -1).alias("b"))
    return (sized.select("id", "dk", F.explode(F.array(
        F.struct(F.col("pos").alias("start"), F.col("a").alias("size")),
        F.struct((F.col("pos") - F.col("b") + 1).alias("start"), F.col("b").alias("size")))).alias("r"))
        .select("id", "dk", "r.*").where("size is not null").distinct())


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(dk, gone): the line numbers to delete of every document that has any."""
    levels = doubled_names(staged(line_table(docs, id_col, text_col), "lines"), min_words)
    runs = staged(_runs(levels[0], min_words), "runs")
    later = None
    for k, names in enumerate(levels):
        width = 1 << k
        own = runs.where((F.col("size") >= width) & (F.col("size") < 2 * width))
        left = names.select("dk", F.col("pos").alias("start"), "n_dk", "n_pos")
        right = names.select("dk", F.col("pos").alias("tail"), F.col("n_dk").alias("m_dk"),
                             F.col("n_pos").alias("m_pos"))
        # a run is two overlapping runs of the level; it is repeated only if both are
        both = (own.join(left, ["dk", "start"])
                .withColumn("tail", F.col("start") + F.col("size") - width).join(right, ["dk", "tail"]))
        key = ["size", "n_dk", "n_pos", "m_dk", "m_pos"]
        place = F.struct("id", "dk", "start")
        first = both.groupBy(*key).agg(F.min(place).alias("first"), F.count("*").alias("times")).where("times > 1")
        found = (both.join(first, key)
                 .where(~((F.col("first.dk") == F.col("dk")) & (F.col("first.start") == F.col("start"))))
                 .select("dk", "start", "size"))
        later = found if later is None else later.unionByName(found)
    covered = (later.select("dk", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("pos"))
               .distinct())
    return (levels[0].select("dk", "pos", "line").join(covered, ["dk", "pos"])
            .groupBy("dk").agg(F.sort_array(F.collect_list("line")).alias("gone")))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                text_col: str = "text", count_col: str = "n_lines_removed") -> DataFrame:
    """``docs`` with the later copies deleted from the text, and their number as
    ``count_col`` (replacing a column of that name)."""
    gone = staged(later_copies(docs, min_words, id_col, text_col), "gone")
    columns = [c for c in docs.columns if c != count_col]
    own = [f"c{k}" for k in range(len(columns))]
    text = F.col(own[columns.index(text_col)])
    keyed = docs.select(*columns).toDF(*own).withColumn("dk", row_key(F.col(own[columns.index(id_col)]), text))
    # a sort-merge join at every size: ``gone`` grows with the corpus, and a hot source is split
    joined = keyed.join(gone.hint("merge"), "dk", "left")
    kept = F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(F.col("gone"), i))
    blank = F.forall(kept, lambda x: x.rlike(r"^[\x20\x09-\x0D]*$"))
    new = (F.when(F.col("gone").isNull(), text).when(blank, F.lit(""))
           .otherwise(F.array_join(kept, "\n")))
    return joined.select(
        *(new.alias(c) if c == own[columns.index(text_col)] else F.col(c) for c in own),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("removed")
    ).toDF(*columns, count_col)
