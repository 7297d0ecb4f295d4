"""Mixing sources to target weights [native].

Each source's words form one stream (documents in an order fixed by a hash and
the id), cut into blocks of ``block`` words.  Output shards of ``shard_slots``
block slots are filled by a multinomial draw: every slot gets a seeded uniform
number and with it a source, so a shard's counts are Multinomial(slots, target
shares).  A source's draws are numbered; draw q takes block ``perm(q mod n)`` of
pass ``q div n`` over the source's n blocks, with a pseudorandom affine
permutation per source and pass.  Blocks and draws meet by index.

Over the whole mix a source has an exact quota, ceil(target / block) draws whose
last is cut to the words still due; draws beyond a quota are settled: they go
unused, and quotas not met by the draw are filled by extra slots at the end.  So
the total is the target to the word, and no block is passed over more than
``max_repeats`` times.

Defined results: null texts have size 0 and take nothing; the null source is a
source of its own and comes last; rows equal in all columns are separate
documents; no words at all means targets and takes of 0; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyframe.llm.common import WORD, materialize

BLOCK = 256
SHARD_SLOTS = 1024
BUCKET_DOCS = 4096   # documents of one source ordered together


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float = 1.0,
                   max_repeats: float = 3.0) -> DataFrame:
    """``sizes(source, source_size)``, one row per source -> plus weight, target.

    Sources in code point order (UTF-8 bytes, null last) get ``weights`` in turn.
    Targets sum to ``share`` of all words; one above ``max_repeats`` times its
    source's size stops there and the excess is dealt to the others by weight.
    Sorted by size per weight the stopped sources come first, so running sums
    give the level at which the rest stands."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("_k") % len(weights) + 1).cast("int"))
    s = sizes.withColumn("_k", F.row_number().over(by_name) - 1).withColumn("weight", w)
    s = s.withColumn("_cap", F.col("source_size") * float(max_repeats))
    rank = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("_k"))
    before, everything = rank.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = F.sum("source_size").over(everything) * float(share)
    left = total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("_level", left / open_weight)
    # the first source whose cap lies above its own level sets the level of the rest
    level = F.min(F.when(F.col("_cap") >= F.col("_level") * F.col("weight"),
                         F.struct(F.col("_cap") / F.col("weight"), F.col("_k"), F.col("_level"))))
    s = s.withColumn("_at", level.over(everything))
    return s.select("source", "source_size", "weight", F.coalesce(
        F.least(F.col("_cap"), F.col("_at._level") * F.col("weight")), F.col("_cap")).alias("target"))


def _ahead(part: str | None, order: str):
    w = Window.partitionBy(part) if part else Window.partitionBy()
    return w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _stream(docs: DataFrame, buckets: int) -> DataFrame:
    """Adds ``start``: words of the same source before this document.  Totals per
    (source, bucket) are summed up first, so no source is ordered in one task."""
    docs = docs.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(buckets)))
    per = docs.groupBy("source_no", "_bucket").agg(F.sum("size").alias("_words"))
    per = per.withColumn("_before", F.coalesce(
        F.sum("_words").over(_ahead("source_no", "_bucket")), F.lit(0))).drop("_words")
    own = (Window.partitionBy("source_no", "_bucket").orderBy("doc_id", "size")
           .rowsBetween(Window.unboundedPreceding, -1))
    docs = docs.withColumn("_within", F.coalesce(F.sum("size").over(own), F.lit(0)))
    return (docs.join(per, ["source_no", "_bucket"])
            .withColumn("start", F.col("_before") + F.col("_within"))
            .drop("_bucket", "_before", "_within"))


def _uniform(top: Column, *key) -> Column:
    return F.pmod(F.xxhash64(*key), F.greatest(top, F.lit(1)))


def draw_blocks(sources: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS,
                seed: int = 0) -> DataFrame:
    """``sources(source_no, source_size, target)`` -> one row per filled slot: shard,
    source_no, pass_no, block_no, words (taken from the block's start)."""
    s = sources.filter((F.col("source_size") > 0) & (F.col("target") > 0)).select(
        "source_no", "source_size", F.round("target").cast("long").alias("due"),
        F.ceil(F.col("source_size") / block).cast("long").alias("n_blocks"))
    s = s.withColumn("passes", F.expr("due div source_size")).withColumn(
        "rest", F.col("due") - F.col("passes") * F.col("source_size"))
    s = s.withColumn("quota", F.col("passes") * F.col("n_blocks")
                     + F.ceil(F.col("rest") / block).cast("long"))
    s = s.withColumn("_lo", F.coalesce(F.sum("quota").over(_ahead(None, "source_no")), F.lit(0)))
    total = s.agg(F.sum("quota").alias("t")).first()["t"] or 0  # one number

    # multinomial draw: slot -> seeded number below total -> the source whose span holds it
    cell = max(1, total // 4096)
    spans = s.select("source_no", "_lo", (F.col("_lo") + F.col("quota")).alias("_hi"), F.explode(
        F.sequence(F.expr(f"_lo div {cell}"),
                   F.expr(f"(_lo + quota - 1) div {cell}"))).alias("_cell")) \
        if total else s.select("source_no", "_lo", F.lit(0).alias("_hi"), F.lit(0).alias("_cell"))
    slots = sources.sparkSession.range(total).select(
        F.expr(f"id div {shard_slots}").alias("shard"),
        _uniform(F.lit(total), F.lit(seed), "id").alias("_u"))
    slots = slots.withColumn("_cell", F.expr(f"_u div {cell}"))
    drawn = (slots.join(spans, "_cell").filter("_u >= _lo AND _u < _hi")
             .groupBy("source_no", "shard").agg(F.count("*").alias("n")))
    drawn = drawn.withColumn("_from", F.coalesce(
        F.sum("n").over(_ahead("source_no", "shard")), F.lit(0)))
    draws = drawn.select("source_no", "shard", F.explode(
        F.sequence("_from", F.expr("_from + n - 1"))).alias("q"))

    # settle: draws above a source's quota are dealt to the sources still short of theirs
    met = s.join(drawn.groupBy("source_no").agg(F.sum("n").alias("_n")), "source_no", "left") \
        .select("source_no", "quota", F.coalesce("_n", F.lit(0)).alias("_n"))
    met = (met.withColumn("_over", F.greatest(F.col("_n") - F.col("quota"), F.lit(0)))
           .withColumn("_short", F.greatest(F.col("quota") - F.col("_n"), F.lit(0)))
           .withColumn("_over0", F.coalesce(F.sum("_over").over(_ahead(None, "source_no")), F.lit(0)))
           .withColumn("_short0", F.coalesce(F.sum("_short").over(_ahead(None, "source_no")), F.lit(0))))
    draws = draws.join(met.select("source_no", "quota", "_over0"), "source_no")
    short = met.filter("_short > 0").select(
        "source_no", F.posexplode(F.sequence("_n", F.expr("quota - 1"))).alias("_i", "q"), "_short0") \
        .select("source_no", "q", (F.col("_i") + F.col("_short0")).alias("_no"))
    spare = draws.filter("q >= quota").select("shard", F.expr("_over0 + q - quota").alias("_no"))
    used = draws.filter("q < quota").select("source_no", "shard", "q").unionByName(
        short.join(spare, "_no").select("source_no", "shard", "q"))

    # draw number -> pass and block, by an affine permutation of the full blocks; the
    # short last block ends each pass
    used = used.join(s.drop("quota", "_lo"), "source_no")
    used = used.withColumn("pass_no", F.expr("q div n_blocks")).withColumn(
        "_k", F.expr("q % n_blocks")).withColumn("_m", F.expr("n_blocks - 1"))
    # fixed values: primes; at most a few of them divide a block count
    primes = F.array(*[F.lit(p) for p in (
        15485863, 32452843, 49979687, 67867967, 86028121, 104395301, 122949823, 141650939)])
    fit = F.filter(primes, lambda p: F.col("_m") % p != 0)
    pick = F.get(fit, _uniform(F.size(fit), F.lit(seed), F.lit("a"), "source_no", "pass_no").cast("int"))
    shift = _uniform(F.col("_m"), F.lit(seed), F.lit("c"), "source_no", "pass_no")
    perm = (F.col("_k") * pick + shift) % F.col("_m")
    at = F.when(F.col("_k") == F.col("_m"), F.col("_m")).otherwise(perm)
    full = F.when(F.col("_k") == F.col("_m"),
                  F.col("source_size") - F.col("_m") * block).otherwise(F.lit(block))
    words = F.when(F.col("pass_no") < F.col("passes"), full).otherwise(
        F.least(full, F.col("rest") - F.col("_k") * block))
    return used.select("shard", "source_no", "pass_no", at.alias("block_no"), words.alias("words"))


def mix_sources(docs: DataFrame, weights: Sequence[float], share: float = 1.0,
                max_repeats: float = 3.0, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """``docs(doc_id, text, source)`` -> doc_id, source, size, source_size, target,
    taken: one row per document."""
    slim = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")),
                       "mix-sizes")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = source_targets(sizes, weights, share, max_repeats)
    sources = materialize(sources.withColumn("source_no", F.row_number().over(
        Window.orderBy(F.col("source").isNull(), F.col("source")))), "mix-sources")
    name = sources.select(F.col("source").alias("_s"), "source_no", "source_size", "target")
    known = slim.join(name, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = slim.count()
    known = materialize(_stream(known, max(1, rows // BUCKET_DOCS)).withColumn(
        "row_no", F.monotonically_increasing_id()), "mix-stream")
    taken = draw_blocks(sources, block, seed=seed).groupBy("source_no", "block_no").agg(
        F.collect_list("words").alias("takes"))  # a block is taken max_repeats times at most
    pieces = known.filter("size > 0").select("source_no", "row_no", "start", "size", F.explode(
        F.sequence(F.expr(f"start div {block}"),
                   F.expr(f"(start + size - 1) div {block}"))).alias("block_no"))
    lo = F.greatest(F.col("start") - F.col("block_no") * block, F.lit(0))
    hi = F.least(F.col("start") + F.col("size") - F.col("block_no") * block, F.lit(block))
    pieces = pieces.withColumns({"lo": lo, "hi": hi}).join(taken, ["source_no", "block_no"])
    got = F.aggregate("takes", F.lit(0).cast("long"), lambda a, w: a + F.greatest(
        F.least(w, F.col("hi")) - F.col("lo"), F.lit(0)))
    per_doc = pieces.groupBy("row_no").agg(F.sum(got).alias("taken"))
    return known.join(per_doc, "row_no", "left").select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
