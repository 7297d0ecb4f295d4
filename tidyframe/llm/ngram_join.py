"""N-gram Jaccard self-join: a grouped prefix join.

A document is the set of the 64-bit hashes of its word shingles.  Documents with
the same set are one class.  Sets are ordered by hash; two sets with Jaccard
similarity t or more share at least k of their first p + k - 1 elements, where
p = n - ceil(t n) + 1 (the prefix).

1. Classes of which fewer than k prefix elements occur in any other class are out:
   they link to nothing.  (Prefix elements travel packed by hash range; elements
   repeated within a task's chunk travel once.)
2. The rest ("survivors") get their full sets.  Star rounds join each class with the
   most central class of its bucket, verify, and merge what is linked.
3. The join proper: classes with identical prefixes and size that are already
   connected form a group; groups meet in the buckets of their prefix elements.  A
   group pair must lie in different components, have fitting sizes and pass a parity
   sketch (its differing bits never exceed the true symmetric difference); it is then
   expanded and its members verified.  Elements all of whose classes are connected
   are left out, and of the others each group leaves out the k - 1 most frequent.
4. Components of the verified links; every link between different sets is either
   verified or lies inside a component already.

Defined results: null or empty texts have no shingles, and their own id as
component; a text of fewer words than a shingle is one shingle; null ids form
classes as others do, a component of null ids only is null; repeated rows share a
component; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyframe.llm.common import (
    hash_words,
    join_rows,
    materialize,
    slices,
    split_words,
    text_key,
    window_hashes,
)
from tidyframe.llm.components import connected_components

STAR_TOKENS = 12       # prefix elements that the star round uses
LARGE, CELL, NEIGHBOURS = 32, 4096, 3
BUCKET_TOKENS = 1_000_000
FEW_PAIRS = 100_000    # 1.6 MB: as many candidate pairs may be broadcast
SKETCH, WIDE = 12, 32  # longs of the parity sketches
HEAD = 6               # rarest mixed elements that a group carries to each bucket


class Similarity:
    """100 * intersection >= percent * union, and the lengths that follow from it."""

    def __init__(self, width: int, percent: int):
        self.width, self.percent = width, percent

    def least(self, n):
        """Elements that a set of n shares with any set it links to."""
        return (self.percent * n + 99) // 100

    def extra(self, n):
        return (n - self.least(n) + 1) // 3

    def region(self, n):
        """Length of the extended prefix."""
        return n - self.least(n) + 1 + self.extra(n)

    def least_sql(self, n: str) -> str:
        return f"(({self.percent} * {n} + 99) div 100)"

    def need_sql(self, n: str = "n") -> str:
        """Prefix elements that a linked partner, the smallest one too, shares."""
        low = f"(({self.percent} * {n} + 99) div 100)"
        return f"(1 + ({low} - (({self.percent} * {low} + 99) div 100) + 1) div 3)"

    def region_sql(self, n: str = "n") -> str:
        p = f"({n} - (({self.percent} * {n} + 99) div 100) + 1)"
        return f"({p} + {p} div 3)"


def _sets(part, width: int):
    """Sorted distinct shingle hashes of each text."""
    ids, starts, words = split_words(part.column("text").to_pylist(), lower=True)
    hashes = hash_words(words)
    for k in range(part.num_rows):
        own = hashes[ids[starts[k]:starts[k + 1]]]
        yield np.unique(window_hashes(own, min(width, len(own)))) if len(own) else own


def _fingerprint(own: np.ndarray) -> tuple[int, int]:
    import xxhash

    code = xxhash.xxh3_128_intdigest(own.tobytes())
    return (code >> 64) - (1 << 63), (code & (1 << 64) - 1) - (1 << 63)


def _signatures(width: int):
    def run(batches):
        import pyarrow as pa

        for part in slices(batches):
            n, codes = [], []
            for own in _sets(part, width):
                n.append(len(own))
                codes.append(_fingerprint(own))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("key"), pa.array(n, pa.int64()),
                 *(pa.array([c[k] for c in codes], pa.int64()) for k in (0, 1))],
                names=["doc_id", "key", "n", "fp1", "fp2"])

    return run


def _deal(sim: Similarity, buckets: int):
    """Prefix elements (their upper 32 bits) of a chunk of texts, cut into hash ranges.
    ``toks`` / ``ids``: elements and the set of each, 0 where the chunk itself has the
    element in two sets (those are counted here, in ``own_ids`` / ``own_counts``).
    A set goes by 64 bits of its fingerprint; equal sets are one."""

    def run(batches):
        import pyarrow as pa

        no = 0
        for part in slices(batches, max_bytes=16 << 20):
            sets = {}
            for own in _sets(part, sim.width):
                if len(own):
                    sets[_fingerprint(own)[0] or 1] = (own[:sim.region(len(own))] >> np.uint64(32)).astype(
                        np.uint32)
            if not sets:
                continue
            toks = np.concatenate(list(sets.values()))
            ids = np.repeat(np.array(list(sets), np.int64), [len(r) for r in sets.values()])
            order = np.argsort(toks, kind="stable")
            toks, ids = toks[order], ids[order]
            first = np.flatnonzero(np.append(True, toks[1:] != toks[:-1]))
            size = np.diff(np.append(first, len(toks)))
            own_ids, own_counts = np.unique(ids[np.repeat(size > 1, size)], return_counts=True)
            toks, ids = toks[first], np.where(size > 1, 0, ids[first])
            home = (toks.astype(np.uint64) * np.uint64(buckets)) >> np.uint64(32)
            cuts = np.searchsorted(home, np.arange(buckets + 1))
            rows = [(b, toks[x:y].tobytes(), ids[x:y].tobytes(), b"", b"")
                    for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if x < y]
            rows.append((no % buckets, b"", b"", own_ids.tobytes(), own_counts.astype(np.int64).tobytes()))
            no += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()),
                 *(pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 5))],
                names=["bucket", "toks", "ids", "own_ids", "own_counts"])

    return run


def _meet(table):
    """Per set, how many of its elements in this hash range another set has too."""
    import pyarrow as pa

    join = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
    toks, ids = join("toks", np.uint32), join("ids", np.int64)
    order = np.lexsort((ids, toks))
    toks, ids = toks[order], ids[order]
    new = np.append(True, toks[1:] != toks[:-1]) if len(toks) else np.empty(0, bool)
    other = new | np.append(True, ids[1:] != ids[:-1]) if len(toks) else new
    group = np.cumsum(new) - 1
    # distinct sets of each element; a 0 stands for two or more
    count = np.bincount(group, other.astype(np.int64) + (ids == 0))
    ids = ids[other & (ids != 0) & (count[group] > 1)] if len(toks) else ids
    ids, counts = np.unique(ids, return_counts=True)
    return pa.table({"fp": np.concatenate([ids, join("own_ids", np.int64)]),
                     "shared": np.concatenate([counts.astype(np.int64), join("own_counts", np.int64)])})


def _parity(own: np.ndarray, longs: int) -> np.ndarray:
    """Bit i: whether the set has an odd number of elements that fall on i."""
    spot = (own >> np.uint64(16)) % np.uint64(64 * longs)
    odd = np.bincount(spot.astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _full_sets(sim: Similarity):
    def run(batches):
        import pyarrow as pa

        for part in slices(batches):
            want = zip(part.column("fp1").to_pylist(), part.column("fp2").to_pylist(), strict=True)
            rows, sets, sketch, wide = [], [], [], []
            for k, (own, code) in enumerate(zip(_sets(part, sim.width), want, strict=True)):
                if len(own) and _fingerprint(own) == code:
                    rows.append(k)
                    sets.append(own.view(np.int64))
                    sketch.append(_parity(own, SKETCH))
                    wide.append(_parity(own, WIDE))
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(rows, pa.int64())),
                 pa.array([len(s) for s in sets], pa.int64()),
                 *(pa.array(x, pa.list_(pa.int64())) for x in (sets, sketch, wide))],
                names=["id", "n", "shingles", "sketch", "wide"])

    return run


def survivors(docs: DataFrame, sig: DataFrame, classes: DataFrame, sim: Similarity) -> DataFrame:
    """(id, n, shingles, sketch, wide) of the classes that may link to another one."""
    total = sig.agg(F.sum(F.expr(sim.region_sql()))).first()[0] or 0
    dealt = docs.select("text").mapInArrow(
        _deal(sim, max(1, total // BUCKET_TOKENS)),
        "bucket long, toks binary, ids binary, own_ids binary, own_counts binary")
    shared = dealt.groupBy("bucket").applyInArrow(_meet, "fp long, shared long")
    fp = F.when(F.col("fp1") == 0, F.lit(1)).otherwise(F.col("fp1"))
    live = (shared.groupBy("fp").agg(F.sum("shared").alias("shared"))
            .join(classes.withColumn("fp", fp), "fp")
            .filter(f"shared >= {sim.need_sql()}")
            .select("id", "fp1", "fp2", F.col("rep.doc_id").alias("doc_id"), F.col("rep.key").alias("key")))
    rows = join_rows(docs.select("doc_id", text_key().alias("key"), "text"), live, ["doc_id", "key"])
    sets = materialize(rows.select("id", "fp1", "fp2", "text").mapInArrow(
        _full_sets(sim), "id long, n long, shingles array<long>, sketch array<long>, wide array<long>"), "shingle-sets")
    twice = sets.select("id").groupBy("id").count().filter("count > 1").limit(1).count()
    return materialize(sets.dropDuplicates(["id"]), "shingle-sets") if twice else sets


def _fits(sim: Similarity) -> Column:
    return (sim.percent * F.greatest("n_a", "n_b") <= 100 * F.least("n_a", "n_b"))


def _near(sim: Similarity, a: Column, b: Column, longs: int, loose: list[Column]) -> Column:
    """The sketches ``a`` and ``b`` of sets of n_a and n_b elements differ in no more bits
    than linked sets do in elements, the bits of ``loose`` (or null) aside."""
    differ = F.lit(0)
    for k in range(longs):
        bits = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        for mask in loose:
            bits = bits.bitwiseAND(F.bitwise_not(F.coalesce(F.get(mask, F.lit(k)), F.lit(0).cast("long"))))
        differ = differ + F.bit_count(bits)
    return (100 + sim.percent) * differ <= (100 - sim.percent) * (F.col("n_a") + F.col("n_b"))


def _close(sim: Similarity, name: str, longs: int) -> Column:
    """The sketches differ in no more bits than linked sets do in elements."""
    return _near(sim, F.col(f"{name}_a"), F.col(f"{name}_b"), longs, [])


def _spread_sketch() -> list[Column]:
    """A group's sketch, a column per long, and the bits that all its members agree in.  As
    columns without nulls, for the comparison of all that meet in a bucket: its code on
    arrays is over twice as large and takes three times as long."""
    zero = F.lit(0).cast("long")
    sketch = [F.coalesce(F.get("sketch", F.lit(k)), zero).alias(f"bits{k}") for k in range(SKETCH)]
    return sketch + [F.bitwise_not(F.coalesce(F.get("vary", F.lit(k)), zero)).alias(f"fixed{k}")
                     for k in range(SKETCH)]


def _groups_close(sim: Similarity, longs: int = SKETCH) -> Column:
    """As ``_near``, of two groups: only bits that the members of each agree in count."""
    differ = F.lit(0)
    for k in range(longs):
        bits = F.col(f"bits{k}_a").bitwiseXOR(F.col(f"bits{k}_b"))
        differ = differ + F.bit_count(bits.bitwiseAND(F.col(f"fixed{k}_a")).bitwiseAND(F.col(f"fixed{k}_b")))
    return (100 + sim.percent) * differ <= (100 - sim.percent) * (F.col("n_a") + F.col("n_b"))


def _verify(pairs: DataFrame, slim: DataFrame, sets: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs (a, b) that link; the wide sketch goes first, being far smaller than a set."""
    for s in "ba":
        pairs = pairs.join(slim.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"),
                                       F.col("wide").alias(f"wide_{s}")), s)
    pairs = materialize(pairs.filter(_fits(sim) & _close(sim, "wide", WIDE)).select("a", "b"), "pairs")
    if pairs.count() <= FEW_PAIRS:  # 16 bytes each: only sets of these pairs are shuffled
        ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        sets = sets.join(F.broadcast(ends), "id", "left_semi")
    side = lambda c: sets.select(F.col("id").alias(c), F.col("shingles").alias(f"set_{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return both.filter(100 * common >= sim.percent * union).select("a", "b")


def _star_pairs(slim: DataFrame) -> DataFrame:
    """Each class with the most central one of each of its first buckets and, in large
    buckets, with its neighbours by centrality (cells of about CELL classes)."""
    toks = slim.select("id", F.explode(F.slice("prefix", 1, STAR_TOKENS)).alias("tok"))
    common = toks.groupBy("tok").agg(F.count("*").alias("df")).filter("df > 1")
    toks = materialize(toks.join(common, "tok"), "star-buckets")
    # the class whose elements are the most common stands nearest to the others
    central = toks.groupBy("id").agg(F.sum(F.log2("df")).alias("central"))
    toks = toks.join(central, "id")
    top = toks.groupBy("tok").agg(F.max(F.struct("central", "id")).alias("top"))
    pairs = toks.join(top, "tok").select(F.col("top.id").alias("a"), F.col("id").alias("b"))
    cell = Window.partitionBy("tok", F.pmod(F.xxhash64("id"), F.ceil(F.col("df") / CELL))) \
        .orderBy("central", "id")
    near = toks.filter(F.col("df") >= LARGE).select("id", *(
        F.lag("id", k).over(cell).alias(f"p{k}") for k in range(1, NEIGHBOURS + 1)))
    for k in range(1, NEIGHBOURS + 1):
        pairs = pairs.unionByName(near.filter(f"p{k} IS NOT NULL").select(
            F.least("id", f"p{k}").alias("a"), F.greatest("id", f"p{k}").alias("b")))
    return pairs.filter("a <> b").distinct()


def _group_pairs(slim: DataFrame, comps: DataFrame, sim: Similarity) -> DataFrame:
    """Member pairs of group pairs that meet in a bucket, in different components."""
    member = slim.join(comps, "id").withColumn("grp", F.xxhash64("prefix", "n", "comp"))
    groups = member.groupBy("grp").agg(  # identical prefixes and size, connected
        F.first("n").alias("n"), F.first("comp").alias("comp"), F.first("prefix").alias("prefix"))
    toks = groups.select("grp", "n", "comp", F.explode("prefix").alias("tok"))
    mixed = toks.groupBy("tok").agg(F.count("*").alias("df"), F.min("comp").alias("lo"),
                                    F.max("comp").alias("hi")).filter("lo < hi").select("tok", "df")
    # of m elements in mixed buckets a linked partner shares need; leaving out the
    # need - 1 most frequent ones (the same order for all) keeps one they share
    kept = toks.join(mixed, "tok").groupBy("grp").agg(
        F.first("n").alias("n"), F.first("comp").alias("comp"),
        F.array_sort(F.collect_list(F.struct("df", "tok"))).alias("mixed"))
    kept = kept.withColumn("keep", F.expr(f"cast(size(mixed) - {sim.need_sql()} + 1 AS int)")).filter("keep > 0")
    bit = lambda f, k: f(F.get("sketch", F.lit(k)))
    masks = member.groupBy("grp").agg(
        F.collect_list(F.struct("id", "sketch")).alias("members"),
        F.array(*[bit(F.bit_and, k) for k in range(SKETCH)]).alias("sketch"),
        F.when(F.count("*") > 1, F.array(*[
            bit(F.bit_and, k).bitwiseXOR(bit(F.bit_or, k)) for k in range(SKETCH)])).alias("vary"))
    units = materialize(kept.join(masks, "grp").select(
        "grp", "n", "comp", "members", "sketch", "vary",
        F.transform(F.slice("mixed", F.lit(1), F.col("keep")), lambda x: x["tok"]).alias("toks")), "groups")
    toks = units.select("grp", "n", "comp", *_spread_sketch(), F.slice("toks", 1, HEAD).alias("head"),
                        F.explode("toks").alias("tok"))
    side = lambda s: toks.select("tok", *(F.col(c).alias(f"{c}_{s}") for c in toks.columns[:-1]))
    # a pair that meets in several buckets is taken in the first of the heads' common ones
    first = F.get(F.array_intersect("head_a", "head_b"), F.lit(0))
    meet = side("a").join(side("b"), "tok").filter(
        (F.col("comp_a") < F.col("comp_b")) & _fits(sim) & _groups_close(sim)
        & (F.coalesce(first, F.col("tok")) == F.col("tok")))
    meet = meet.select("grp_a", "grp_b", "n_a", "n_b").distinct()
    # members of a near to what the members of b have in common, then those of b near to them
    inside = lambda s: units.select(F.col("grp").alias(f"grp_{s}"), "members")
    common = units.select(F.col("grp").alias("grp_b"), F.col("sketch").alias("both"), "vary")
    meet = meet.join(common, "grp_b").join(inside("a"), "grp_a").select(
        "grp_b", "n_a", "n_b", F.explode(F.filter("members", lambda x: _near(
            sim, x["sketch"], F.col("both"), SKETCH, [F.col("vary")]))).alias("x"))
    meet = meet.join(inside("b"), "grp_b").select("x", F.explode(F.filter("members", lambda y: _near(
        sim, F.col("x.sketch"), y["sketch"], SKETCH, []))).alias("y"))
    return meet.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def similarity_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, key (``common.text_key``), n_shingles,
    component_id, rep_key: one row per row; rows of one (doc_id, key) are equal.
    ``is_first`` marks the rows of the component's first document."""
    sim = Similarity(width, percent)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    sig = materialize(
        docs.select("doc_id", text_key().alias("key"), "text").mapInArrow(
            _signatures(width), f"doc_id {id_type}, key long, n long, fp1 long, fp2 long"), "signatures")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    classes = materialize(
        sig.filter("n > 0").groupBy("fp1", "fp2").agg(F.min(place).alias("rep"), F.first("n").alias("n"))
        .withColumn("id", F.monotonically_increasing_id()), "classes")
    sets = survivors(docs, sig, classes, sim)
    slim = materialize(sets.select("id", "n", "sketch", "wide", F.expr(
        f"slice(shingles, 1, cast({sim.region_sql()} AS int))").alias("prefix")), "survivors")
    stars = materialize(_verify(_star_pairs(slim), slim, sets, sim), "star-links")
    merged = connected_components(stars)
    comps = materialize(slim.select("id").join(merged.withColumnRenamed("node", "id"), "id", "left").select(
        "id", F.coalesce("component", "id").alias("comp")), "star-components")
    links = stars.unionByName(_verify(_group_pairs(slim, comps, sim), slim, sets, sim))
    comp = connected_components(links)

    named = classes.select("id", "fp1", "fp2", "rep").join(
        comp.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    first = named.groupBy("component").agg(F.min("rep").alias("first"))
    named = named.join(first, "component").select("fp1", "fp2", "first")
    rows = sig.select("doc_id", "key", "n", "fp1", "fp2").join(named, ["fp1", "fp2"], "left")
    alone = F.col("first").isNull()
    return rows.select(
        "doc_id", "key", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        F.when(alone, F.lit(True)).otherwise(
            F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
        ).alias("is_first"))


def drop_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component (the first by id; of rows equal in id and text,
    one) and every document without shingles, with all columns."""
    keep = similarity_components(docs, width, percent).filter("is_first").select(
        "doc_id", F.col("key").alias("__dockey")).distinct()
    rows = join_rows(docs.withColumn("__dockey", text_key()), keep, ["doc_id", "__dockey"], "left_semi")
    empty = F.length(F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\f\r"))) == 0
    return rows.filter(~empty).dropDuplicates(["doc_id", "__dockey"]).unionByName(
        rows.filter(empty)).drop("__dockey")
