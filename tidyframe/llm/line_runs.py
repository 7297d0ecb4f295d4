"""Line dedup with a suffix array over line numbers.

A document is its sequence of non-blank lines (ASCII white space trimmed at both
ends).  Lines that occur once in the whole corpus can not be part of a repeat and
leave at once.  The others get ranks, and prefix doubling turns ranks of h lines
into ranks of 2h lines: sort the pairs (rank, rank h lines on) by range over the
cluster, number the distinct pairs in order.  After the step that reaches
``min_lines`` the ranks order all suffixes to that depth, and the suffixes of one
rank are an interval of the suffix array whose longest common prefix is at least
``min_lines`` lines.  Every member of an interval but the first (by doc_id, then
place) starts a later copy; overlapping copies make up the maximal repeated runs,
whose lines are deleted.  Depth beyond ``min_lines`` would change nothing: a
longer repeat is covered by its windows of ``min_lines``.

A single line is a run of its own if it has ``min_words`` words.

Defined results: null texts stay null, empty ones empty; blank lines are neither
compared nor deleted; null ids come last in the order of copies; rows equal in id
and text count as one document and come out alike; copies inside one document
count too; an empty table gives no rows; all columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidyframe.llm.common import WORD, join_rows, materialize, text_key

MIN_LINES = 4
MIN_WORDS = 10
_SPACE = " \t\n\x0b\f\r"


def global_rank(rows: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Number the rows 1.. in the order of ``cols``: sorted by range over the
    cluster, each partition offset by the sizes of those before it."""
    placed = materialize(
        rows.repartitionByRange(*cols).sortWithinPartitions(*cols).select(
            "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")),
        "rank")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = placed.groupBy("_part").count().select(  # a row per partition
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(offset), "_part").select(
        *rows.columns, (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias(name))


def line_table(docs: DataFrame) -> DataFrame:
    """(doc_id, key, k, pos, h1, h2, words): the k-th non-blank line, at line ``pos``."""
    lines = F.filter(
        F.transform(F.split("text", "\n"), lambda x, i: F.struct(
            i.alias("pos"), F.btrim(x, F.lit(_SPACE)).alias("line"))),
        lambda x: x["line"] != "")
    rows = docs.select("doc_id", text_key().alias("key"), "text").dropDuplicates(["doc_id", "key"])
    rows = rows.select("doc_id", "key", F.posexplode(lines).alias("k", "x"))
    return rows.select(
        "doc_id", "key", "k", F.col("x.pos").alias("pos"), F.xxhash64("x.line").alias("h1"),
        F.xxhash64(F.lit("line"), "x.line").alias("h2"),
        F.regexp_count("x.line", F.lit(WORD)).alias("words"))


def _renumber(rows: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Rows whose values of ``cols`` occur twice or more, with the rank of the values."""
    again = rows.groupBy(*cols).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    return rows.join(global_rank(again, cols, name), cols)


def suffix_ranks(lines: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """(rank of single lines, rank of ``depth`` lines) for the rows that share it
    with another row."""
    one = materialize(_renumber(lines, ["h1", "h2"], "rank").select(
        "doc_id", "key", "k", "pos", "words", "rank"), "line-ranks")
    rows, h = one, 1
    while h < depth:
        step = min(h, depth - h)
        ahead = rows.select("doc_id", "key", (F.col("k") - step).alias("k"), F.col("rank").alias("rank2"))
        pairs = join_rows(rows, ahead, ["doc_id", "key", "k"]).select(
            "doc_id", "key", "k", F.col("rank").alias("rank1"), "rank2")
        rows = materialize(_renumber(pairs, ["rank1", "rank2"], "rank").select(
            "doc_id", "key", "k", "rank"), f"suffix-ranks-{h + step}")
        h += step
    return one, rows


def _later(rows: DataFrame) -> DataFrame:
    """Rows that are not the first of their rank."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "k")
    # written, so that both sides of the join are plain inputs: Spark broadcasts the
    # first copies where they are few, and otherwise splits a rank of very many rows
    first = materialize(rows.groupBy("rank").agg(F.min(place).alias("_first")), "first-copies")
    return rows.join(first, "rank").filter(place != F.col("_first"))


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES,
                   min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, key, removed, runs): the line places to delete and the number of unbroken runs
    of non-blank lines they make, one row per document with any."""
    lines = materialize(line_table(docs), "lines")
    one, deep = suffix_ranks(lines, min_lines)
    at = lambda rows: rows.select("doc_id", "key", "k")
    runs = _later(deep).select("doc_id", "key", F.explode(
        F.transform(F.sequence(F.lit(0), F.lit(min_lines - 1)), lambda i: F.col("k") + i)).alias("k"))
    hit = at(_later(one.filter(F.col("words") >= min_words))).unionByName(runs).distinct()
    found = join_rows(one, hit, ["doc_id", "key", "k"])
    per_doc = found.groupBy("doc_id", "key").agg(F.collect_set("pos").alias("removed"), F.collect_set("k").alias("ks"))
    starts = F.array_except("ks", F.transform("ks", lambda i: i + 1))
    return per_doc.select("doc_id", "key", "removed", F.size(starts).alias("runs"))


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES,
                min_words: int = MIN_WORDS) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> the same rows with ``text`` rid of later copies,
    plus n_lines (non-blank ones before), n_removed and n_runs."""
    gone = repeated_lines(docs, min_lines, min_words).select(
        F.col("key").alias("__dockey"), "doc_id", F.col("removed").alias("__removed"), F.col("runs").alias("__runs"))
    rows = join_rows(docs.withColumn("__dockey", text_key()), gone, ["doc_id", "__dockey"], "left")
    lines = F.split("text", "\n")
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__removed")
    text = F.when(F.col("__removed").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(keep, lambda i: F.get(lines, i)), "\n"))
    added = ("n_lines", "n_removed", "n_runs")  # take the place of columns of that name
    out = [text.alias(c) if c.lower() == "text" else F.col(f"`{c}`")
           for c in docs.columns if c.lower() not in added]
    blank = F.size(F.filter(lines, lambda x: F.btrim(x, F.lit(_SPACE)) != ""))
    return rows.select(
        *out, F.coalesce(F.when(F.col("text").isNotNull(), blank), F.lit(0)).alias("n_lines"),
        F.when(F.col("__removed").isNull(), 0).otherwise(F.size("__removed")).alias("n_removed"),
        F.coalesce(F.col("__runs"), F.lit(0)).alias("n_runs"))
