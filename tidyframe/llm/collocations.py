"""Collocations of two to ``DEPTH`` words, after vertical partitioning of the suffixes.

1. Words are counted per language, then the prefixes of two and of ``PRUNED`` words, by a
   32-bit hash.  A phrase is frequent only if all its words, pairs and triples are, so every
   rarer one ends a piece as punctuation does.  Tasks know the frequent ones by bitmaps of
   fixed size (2 ** BITS bits, whatever the corpus).  A hash that two share can only let a rare
   one pass: it costs a row and changes no result.
2. Each word that begins a window of two words and more which may be frequent starts a suffix:
   the longest such window, of up to ``DEPTH`` words.  Equal suffixes are counted per task
   (at most ``TASK_LEAVES`` at a time), then over the corpus: these are the leaves with their
   totals.  A task tells a leaf once, so copied passages travel once a task.
3. Vertical partitioning: leaves belong to the prefix of one word; a prefix of more
   than ``GROUP_LEAVES`` leaves is split by its next word, and so on to the full depth.
   Prefixes are packed into groups up to that budget of leaves.
4. A group's subtree is built alone, in one task's memory: its leaves are sorted, a node of
   depth d is a run with equal first d words, and its count is the sum of the leaf totals
   in the run.  Nodes above a split prefix are parts that are added up at the end.
5. Scores come from joins of a candidate's two parts with the counts, in exact
   decimals of 38 digits (a product of more raises; corpora stay far below).

Defined results: a null language counts as ``und``; null and empty texts hold no words; very
long texts and words are taken whole; rows are counted as they come, repeated ones too,
whatever their ids; an empty table gives no rows; extra columns are ignored.  Ties of
scores go by count, then by phrase.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyframe.llm.common import hash_words, materialize, mix64, slices, utf8

DEPTH = 5
MIN_COUNT = 100
TOP = 2000
ABSORB = 100              # per cent of a phrase's occurrences in a longer one that drop it
BITS = 25                 # of each bitmap: 4 MiB
PRUNED = 3                # words of the longest prefix that is counted before the leaves
TASK_LEAVES = 100_000     # distinct leaves that a task counts in memory
GROUP_LEAVES = 100_000    # leaves of a subtree in one task's memory
LANES = 32                # of the last ranking and of the join with a language's total
NO_LANG = "und"
_PACK = 21                # bits of a word number, three to a sort key

#: characters that end a piece become one mark that no word can hold
_BREAKS = bytes(ord(".") if c in b".,;:!?\n\v\f\r" else 32 if c == 9 else c for c in range(256))


# ---------------------------------------------------------------- inside tasks


def _pieces(texts):
    """(word numbers with 0 between pieces, words) of some texts."""
    seen: defaultdict = defaultdict()
    seen.default_factory = seen.__len__
    ids = [seen[b"."]]
    for text in texts:
        raw = utf8(text).lower().translate(_BREAKS).replace(b".", b" . ")
        ids += [seen[w] for w in raw.split()]
        ids.append(0)
    return np.array(ids, dtype=np.int32), list(seen)


def _by_lang(batches):
    """(lang, word numbers, words) per language of each chunk."""
    for part in slices(batches):
        texts = defaultdict(list)
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
            texts[lang].append(text)
        for lang, some in texts.items():
            yield lang, *_pieces(some)


def _hashes(lang: str, words) -> np.ndarray:
    own = lang.encode() + b"\0"
    return hash_words([own + w for w in words])


def _known(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = h & np.uint64((1 << BITS) - 1)
    return (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) > 0


def _strings(values):
    import pyarrow as pa

    return pa.array(values, pa.binary()).cast(pa.string())


def _count_words(batches):
    """Words with their hashes and counts; under the null word, the count of all."""
    import pyarrow as pa

    for lang, ids, words in _by_lang(batches):
        n = np.bincount(ids, minlength=len(words))
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(words), pa.string()), _strings([None, *words[1:]]),
             pa.array(np.append(np.uint64(0), _hashes(lang, words[1:])).view(np.int64)),
             pa.array(np.concatenate([[n[1:].sum()], n[1:]]), pa.int64())], names=["lang", "word", "h", "f"])


def _linked(lang: str, ids: np.ndarray, words, bitmaps: list[np.ndarray], widest: int):
    """For each width up to ``widest``: which windows of that width may be part of a frequent
    phrase; and the hashes of the widest ones."""
    own = _hashes(lang, words)
    first = _known(bitmaps[0], own)
    first[0] = False
    gram = h = own[ids]
    out = [first[ids]]
    for width in range(2, widest + 1):
        gram = mix64(mix64(gram[:-1]) + mix64(~h[width - 1:]) * np.uint64(0x9E3779B97F4A7C15))
        may = out[-1][:-1] & out[-1][1:]
        if width <= len(bitmaps):
            may[may] = _known(bitmaps[width - 1], gram[may])
        out.append(may)
    return out, gram


def _count_grams(bitmaps: list[np.ndarray]):
    """Windows one word wider than the bitmaps know, by the low half of their hash."""

    def run(batches):
        import pyarrow as pa

        for lang, ids, words in _by_lang(batches):
            linked, gram = _linked(lang, ids, words, bitmaps, len(bitmaps) + 1)
            found, n = np.unique(gram[linked[-1]].astype(np.uint32), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int32)), pa.array(n, pa.int64())], names=["h", "f"])

    return run


def _sorted_rows(m: np.ndarray) -> np.ndarray:
    """Order of rows by their columns from left to right."""
    if not len(m):
        return np.empty(0, np.int64)
    keys = [m[:, k] for k in range(m.shape[1])]
    if int(m.max()) < 1 << _PACK:  # three columns to a key
        wide = [k.astype(np.int64) for k in keys] + [np.zeros(len(m), np.int64)] * (-len(keys) % 3)
        keys = [(a << 2 * _PACK) | (b << _PACK) | c for a, b, c in zip(wide[::3], wide[1::3], wide[2::3], strict=True)]
    return np.lexsort(keys[::-1])


def _leaves(ids: np.ndarray, linked: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct leaves, as rows of word numbers with 0 behind the last, and their counts.
    The leaf of a word is the longest linked window of two words and more that it begins."""
    at = np.flatnonzero(linked[1])
    m = np.zeros((len(at), len(linked)), ids.dtype)
    for k, may in enumerate(linked):
        rows = np.flatnonzero(np.append(may, np.zeros(k, bool))[at])
        m[rows, k] = ids[at[rows] + k]
    m = m[_sorted_rows(m)]
    first = np.flatnonzero(np.append(True, (m[1:] != m[:-1]).any(axis=1))) if len(m) else at
    return m[first], np.diff(np.append(first, len(m)))


def _count_leaves(bitmaps: list[np.ndarray], depth: int, most: int):
    """Leaves with their counts in the task, told whenever it holds ``most`` distinct ones."""

    def told(held):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays(
            [pa.array([lang for lang, _ in held], pa.string()), _strings([leaf for _, leaf in held]),
             pa.array(list(held.values()), pa.int64())], names=["lang", "suffix", "f"])

    def run(batches):
        held: dict[tuple, int] = defaultdict(int)
        for lang, ids, words in _by_lang(batches):
            rows, counts = _leaves(ids, _linked(lang, ids, words, bitmaps, depth)[0])
            for row, n in zip(rows.tolist(), counts.tolist(), strict=True):
                held[lang, b" ".join([words[w] for w in row if w])] += n
            if len(held) >= most:
                yield told(held)
                held.clear()
        yield told(held)

    return run


def subtree(suffixes: list[bytes], totals: np.ndarray, complete_from: np.ndarray, depth: int, least: int):
    """Nodes of two words and more: (phrase, count) of those of ``least`` and more, and of
    all those above a leaf's own prefix (``complete_from`` words), which are parts."""
    seen: dict[bytes, int] = {b"": 0}
    m = np.zeros((len(suffixes), depth), np.int32)
    for k, s in enumerate(suffixes):
        row = [seen.setdefault(w, len(seen)) for w in s.split(b" ")]
        m[k, :len(row)] = row
    words = list(seen)
    order = _sorted_rows(m)
    m, totals, complete_from = m[order], totals[order], complete_from[order]
    fresh = np.append(True, m[1:, 0] != m[:-1, 0])
    for d in range(2, depth + 1):
        fresh = fresh.copy()
        fresh[1:] |= m[1:, d - 1] != m[:-1, d - 1]
        first = np.flatnonzero(fresh)
        count = np.add.reduceat(totals, first)
        keep = (m[first, d - 1] > 0) & ((count >= least) | (complete_from[first] > d))
        for at, n in zip(first[keep].tolist(), count[keep].tolist(), strict=True):
            yield b" ".join([words[w] for w in m[at, :d].tolist()]), n


def _subtrees(depth: int, least: int):
    """Rows sorted by group -> the nodes of each group's subtree."""

    def grow(held):
        import pyarrow as pa

        lang = held[0][1]
        nodes = list(subtree([utf8(r[2]) for r in held], np.array([r[3] for r in held], np.int64),
                             np.array([r[4] for r in held], np.int32), depth, least))
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(nodes), pa.string()), _strings([p for p, _ in nodes]),
             pa.array([n for _, n in nodes], pa.int64())], names=["lang", "phrase", "f"])

    def run(batches):
        held: list = []
        for part in batches:
            cols = [part.column(c).to_pylist() for c in ("grp", "lang", "suffix", "f", "words")]
            for row in zip(*cols, strict=True):
                if held and row[:2] != held[-1][:2]:  # a group's languages are subtrees of their own
                    yield grow(held)
                    held = []
                held.append(row)
        if held:
            yield grow(held)

    return run


# ---------------------------------------------------------------- steps


def _head(words: int) -> Column:
    return F.substring_index("suffix", " ", words)


def partition_leaves(leaves: DataFrame, depth: int, budget: int) -> DataFrame:
    """``leaves(lang, suffix, f)`` with ``prefix``, ``words`` (the prefix's length) and
    ``grp``: prefixes of at most ``budget`` leaves, packed up to that budget."""
    routed = leaves.withColumn("prefix", _head(1)).withColumn("words", F.lit(1))
    for k in range(1, depth):
        large = materialize(routed.filter(F.col("words") == k).groupBy("lang", "prefix").count()
                            .filter(F.col("count") > budget).select("lang", "prefix"), f"large-prefixes-{k}")
        if large.isEmpty():
            break
        split = F.col("is_large").isNotNull()
        routed = routed.join(large.withColumn("is_large", F.lit(True)), ["lang", "prefix"], "left").select(
            "lang", "suffix", "f", F.when(split, _head(k + 1)).otherwise(F.col("prefix")).alias("prefix"),
            F.when(split, F.lit(k + 1)).otherwise(F.col("words")).alias("words"))
    sizes = materialize(routed.groupBy("lang", "prefix").count(), "prefixes")
    total = sizes.agg(F.sum("count")).first()[0] or 0
    lanes = total // (16 * budget) + 1  # each packs about sixteen groups
    lane = F.pmod(F.xxhash64("lang", "prefix"), F.lit(lanes))
    before = F.sum("count").over(Window.partitionBy("lane").orderBy("lang", "prefix")) - F.col("count")
    packed = sizes.withColumn("lane", lane).select(
        "lang", "prefix", F.xxhash64("lane", F.floor(before / budget)).alias("grp"))
    return routed.join(packed, ["lang", "prefix"])


def _bitmap(hashed: DataFrame) -> np.ndarray:
    """The rows' hashes ``h`` as a bitmap: 2 ** BITS / 64 rows of two numbers at most reach
    the driver, as columns."""
    bit = F.col("h").bitwiseAND(F.lit((1 << BITS) - 1))
    marks = hashed.select(F.shiftright(bit, 6).cast("int").alias("block"), bit.alias("bit")).groupBy("block").agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("bits")).toArrow()
    out = np.zeros(max(1, 1 << BITS >> 6), np.uint64)
    out[marks.column("block").to_numpy()] = marks.column("bits").to_numpy().view(np.uint64)
    return out


def frequent_phrases(docs: DataFrame, depth: int = DEPTH, min_count: int = MIN_COUNT,
                     budget: int = GROUP_LEAVES) -> tuple[DataFrame, DataFrame]:
    """``docs(lang, text)`` -> (lang, phrase, f) of the words and phrases of ``min_count``
    occurrences and more, and (lang, n) with all words."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), "text")
    counted = materialize(
        texts.mapInArrow(_count_words, "lang string, word string, h long, f long").groupBy("lang", "word", "h")
        .agg(F.sum("f").alias("f")).filter(F.col("word").isNull() | (F.col("f") >= min_count)), "word-counts")
    totals = counted.filter("word IS NULL").select("lang", F.col("f").alias("n"))
    words = counted.filter("word IS NOT NULL").select("lang", F.col("word").alias("phrase"), "f")
    bitmaps = [_bitmap(counted.filter("word IS NOT NULL"))]
    while len(bitmaps) < min(PRUNED, depth):
        grams = texts.mapInArrow(_count_grams(bitmaps), "h int, f long").groupBy("h").agg(F.sum("f").alias("f"))
        bitmaps.append(_bitmap(grams.filter(F.col("f") >= min_count)))
    leaves = materialize(
        texts.mapInArrow(_count_leaves(bitmaps, depth, TASK_LEAVES), "lang string, suffix string, f long")
        .groupBy("lang", "suffix").agg(F.sum("f").alias("f")), "suffix-leaves")
    nodes = (partition_leaves(leaves, depth, budget).select("grp", "lang", "suffix", "f", "words")
             .repartition("grp").sortWithinPartitions("grp", "lang")
             .mapInArrow(_subtrees(depth, min_count), "lang string, phrase string, f long"))
    phrases = nodes.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= min_count)
    return materialize(words.unionByName(phrases), "frequent-phrases"), totals


def _joined(first: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def collocations(docs: DataFrame, depth: int = DEPTH, min_count: int = MIN_COUNT, top: int = TOP,
                 absorb: int = ABSORB, budget: int = GROUP_LEAVES) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    freq, totals = frequent_phrases(docs, depth, min_count, budget)
    split = F.split("phrase", " ", -1)
    lane = F.pmod(F.xxhash64("phrase"), F.lit(LANES))
    spread = totals.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(LANES - 1).cast("long"))))
    cands = materialize(
        freq.withColumn("words", split).filter(F.size("words") > 1).withColumnRenamed("f", "a")
        .withColumn("lane", lane).join(spread, ["lang", "lane"]), "candidates")

    size = F.size("words")
    longer = cands.filter(size > 2).select("lang", "a", F.explode(F.array(
        _joined(F.lit(1), size - 1), _joined(F.lit(2), size - 1))).alias("phrase")).groupBy(
        "lang", "phrase").agg(F.max("a").alias("longer"))  # a longer one's count bounds those between
    kept = cands.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < absorb * F.col("a")))

    k = F.col("k")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang", "phrase", "a", "n", "k", _joined(F.lit(1), k).alias("left"), _joined(k + 1, size - k).alias("right"))
    part = lambda side, f: freq.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
    scored = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]) \
        .select("lang", "phrase", "a", "n", "k", "l", "r", _wide("a").alias("wa"), _wide("n").alias("wn"),
                _wide("l").alias("wl"), _wide("r").alias("wr")) \
        .withColumn("score", F.expr("(wa * wn * CAST(1000 AS DECIMAL(4,0))) DIV (wl * wr)"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = best.withColumn("lane", lane).withColumn(
        "place", F.row_number().over(Window.partitionBy("lang", "lane").orderBy(*order))).filter(F.col("place") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
