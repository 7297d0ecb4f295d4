"""Benchmark decontamination by templates.

Words become template tokens: numbers, names (capitalised words inside a
sentence) and units (after a number) turn into typed placeholders, all others are
lower-cased without edge punctuation.  Windows of ``WIDTH`` template tokens of all
documents are joined by hash with those of the benchmark, aligned by shift, and a
window counts only if its slots are consistent with the others of its shift: one
benchmark value stands for one document value throughout.  A value that stands for
several loses the windows where it is changed; those where it stands for itself, and
those without it, stay.  That finds verbatim passages as well as questions with other
numbers or names put in.

Windows of the plain words, lower-cased and without edge punctuation, are a second
kind in the same join: they find copies in other case, and items of mostly names and
numbers.  An item of fewer than ``WIDTH`` words is one plain window of all its words.

A document is contaminated by an item if, of one kind, the aligned windows cover
``CONTAINED`` of the item's windows, or ``RUN`` windows at one shift match (``RUN`` +
4 words).

Only document windows whose hash falls on a set bit of a fixed-size bitmap of the
benchmark's hashes leave the tasks; the join that follows is exact.

Defined results: null or empty texts are clean; null or empty items, and template
windows with under three literal tokens, match nothing; an item of a word or two
contaminates every document that holds these words; rows equal in id and text are
judged alike; an empty benchmark contaminates nothing; an empty table gives no rows;
extra columns are kept by ``drop_contaminated``.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyframe.llm.common import hash_words, join_rows, slices, split_words, text_key, window_hashes

WIDTH = 5
CONTAINED = 0.8
RUN = 9
BITS = 1 << 22  # of the bitmap: 512 KB whatever the benchmark's size
# fixed values: unit words recognised after a number
UNITS = frozenset(
    b"mm cm m km in ft yd mi mg g kg t lb oz ml l gal s sec min h hr hours days weeks months years "
    b"k mph kmh km/h m/s % percent usd eur gbp dollars euros pounds cents hz khz mhz ghz w kw mw j kj "
    b"cal kcal v a kb mb gb tb meters metres kilometers miles grams kilograms liters litres".split())
_NUMBER = re.compile(rb"^[+\-$]?\d[\d.,:/]*[a-z%]{0,4}$")
_EDGE = b".,;:!?\"'()[]{}<>*_`"
_STOPS = b".!?:"
LITERAL, NUMBER, NAME, UNIT = range(4)


def _fold(word: bytes) -> bytes:
    return word.lower() if word.isascii() else word.decode(
        "utf-8", "surrogatepass").casefold().encode("utf-8", "surrogatepass")


def _tokens(texts):
    """(hashes, types, slot words, starts, plain hashes) of the template tokens of all texts."""
    ids, starts, words = split_words(texts)
    base = [_fold(w.strip(_EDGE)) or w for w in words]
    number = np.fromiter((bool(_NUMBER.match(b)) for b in base), bool, len(words))
    unit = np.fromiter((b in UNITS for b in base), bool, len(words))
    capital = np.fromiter((w.lstrip(_EDGE).decode("utf-8", "replace")[:1].isupper() for w in words),
                          bool, len(words))
    stop = np.fromiter((w.rstrip(b"\"')]}")[-1:] in _STOPS and w[-1:] != b"" for w in words),
                       bool, len(words))
    literal = hash_words(base)
    if not len(ids):
        return np.empty(0, np.uint64), np.empty(0, np.int8), (ids, base), starts, literal
    opens = np.zeros(len(ids) + 1, bool)
    opens[1:] = stop[np.append(ids, ids[-1])][:len(ids)]
    opens[starts[:-1]] = True
    after_number = np.zeros(len(ids), bool)
    after_number[1:] = number[ids[:-1]]
    after_number[starts[:-1][starts[:-1] < len(ids)]] = False
    kind = np.where(number[ids], NUMBER, np.where(
        unit[ids] & after_number, UNIT, np.where(capital[ids] & ~opens[:-1], NAME, LITERAL)))
    marks = hash_words([b"", b"\0number", b"\0name", b"\0unit"])
    hashes = np.where(kind == LITERAL, literal[ids], marks[kind])
    return hashes, kind.astype(np.int8), (ids, base), starts, literal[ids]


def _windows(texts, short: list[int] | None):
    """Yields (text number, width, word place, hashes, slots) of each text's windows; the
    width of template windows is 0, their slots are not None.  Plain windows under
    ``WIDTH`` words: those of the widths ``short``, each only where it stands first, or,
    if that is None, the whole text."""
    hashes, kind, slot, starts, plain = _tokens(texts)
    for k in range(len(texts)):
        a, b = starts[k], starts[k + 1]
        for width in range(1, WIDTH) if short is None else short:
            if width == b - a if short is None else width <= b - a:
                h, at = np.unique(window_hashes(plain[a:b], width), return_index=True)
                yield k, width, at, h, None
        if b - a < WIDTH:
            continue
        h = window_hashes(plain[a:b], WIDTH)
        yield k, WIDTH, np.arange(len(h)), h, None
        h = window_hashes(hashes[a:b], WIDTH)
        words = np.convolve(kind[a:b] == LITERAL, np.ones(WIDTH, int), "valid")
        at = np.flatnonzero(words >= 3)
        yield k, 0, at, h[at], (kind[a:b], slot[0][a:b], slot[1])


def _slots(own, at: int) -> list[str]:
    kind, ids, base = own
    return [base[ids[j]].decode("utf-8", "replace") for j in range(at, at + WIDTH) if kind[j] != LITERAL]


def _emit(keys: list[str], bitmap: np.ndarray | None, short: list[int] | None):
    def run(batches):
        import pyarrow as pa

        for part in slices(batches):
            owner, widths, place, found, slots = [], [], [], [], []
            for k, width, at, h, own in _windows(part.column("text").to_pylist(), short):
                if bitmap is not None:
                    spot = (h % np.uint64(BITS)).astype(np.int64)
                    hit = (bitmap[spot >> 3] >> (spot & 7)) & 1 == 1
                    at, h = at[hit], h[hit]
                owner += [k] * len(at)
                widths += [width] * len(at)
                place += at.tolist()
                found += h.astype(np.int64).tolist()
                slots += [_slots(own, j) if own else [] for j in at.tolist()]
            rows = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c).take(rows) for c in keys), pa.array(widths, pa.int32()),
                 pa.array(place, pa.int64()), pa.array(found, pa.int64()),
                 pa.array(slots, pa.list_(pa.string()))],
                names=[*keys, "width", "place", "hash", "slots"])

    return run


def template_windows(rows: DataFrame, keys: list[str], bitmap: np.ndarray | None = None,
                     short: list[int] | None = None) -> DataFrame:
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys)
    return rows.select(*keys, "text").mapInArrow(
        _emit(keys, bitmap, short), f"{kinds}, width int, place long, hash long, slots array<string>")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated (doc_id, key, item_id): n_windows of the item, matched,
    containment, aligned (most windows at one shift), all of the kind with the higher
    containment; verbatim: the windows of one kind match with equal words throughout."""
    items = template_windows(benchmark, ["item_id"]).select(
        "item_id", "width", F.col("place").alias("item_place"), "hash", F.col("slots").alias("item_slots"))
    short = sorted(r["width"] for r in items.select("width").distinct().collect() if 0 < r["width"] < WIDTH)
    spots = items.select(F.pmod("hash", F.lit(BITS)).alias("b")).distinct().collect()  # <= BITS
    bitmap = np.zeros(BITS // 8, np.uint8)
    for r in spots:
        bitmap[r["b"] >> 3] |= 1 << (r["b"] & 7)
    sizes = items.groupBy("item_id", "width").agg(F.count_distinct("item_place").alias("n_windows"))
    rows = docs.select("doc_id", text_key().alias("key"), "text")
    hits = template_windows(rows, ["doc_id", "key"], bitmap, short).join(items, ["hash", "width"])
    shift = hits.groupBy("doc_id", "key", "item_id", "width",
                         (F.col("place") - F.col("item_place")).alias("s")).agg(
        F.collect_set(F.struct("item_place", F.arrays_zip(
            F.col("item_slots").alias("a"), F.col("slots").alias("b")).alias("pairs"))).alias("windows"))
    pairs = F.array_distinct(F.flatten(F.col("windows.pairs")))
    shift = shift.withColumn("pairs", F.array_sort(pairs))  # those of one benchmark value are neighbours
    shift = shift.withColumn("clash", F.filter("pairs", lambda p, i: (p["a"] != p["b"]) & (
        F.coalesce(F.get("pairs", i - 1)["a"] == p["a"], F.lit(False))
        | F.coalesce(F.get("pairs", i + 1)["a"] == p["a"], F.lit(False)))))
    shift = shift.withColumn("windows", F.filter(
        "windows", lambda w: ~F.exists(w["pairs"], lambda p: F.array_contains("clash", p))))
    shift = shift.filter(F.size("windows") > 0).select(
        "doc_id", "key", "item_id", "width", F.col("windows.item_place").alias("places"),
        F.flatten(F.col("windows.pairs")).alias("pairs"))
    per = shift.groupBy("doc_id", "key", "item_id", "width").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("matched"),
        F.max(F.size("places")).alias("aligned"),
        F.bool_and(F.forall("pairs", lambda p: p["a"] == p["b"])).alias("verbatim"))
    per = per.join(sizes, ["item_id", "width"]).withColumn("containment", F.col("matched") / F.col("n_windows"))
    per = per.filter((F.col("containment") >= CONTAINED) | (F.col("aligned") >= RUN))
    return per.groupBy("doc_id", "key", "item_id").agg(
        F.max(F.struct("containment", "matched", "n_windows", "aligned")).alias("best"),
        F.bool_or("verbatim").alias("verbatim")).select(
        "doc_id", "key", "item_id", "best.n_windows", "best.matched", "best.aligned", "verbatim",
        "best.containment")


def judge_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, item_ids (sorted), containment (highest), verbatim: one
    row per document."""
    leaks = find_leaks(docs, benchmark).groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.max("containment").alias("containment"), F.bool_or("verbatim").alias("verbatim"))
    rows = docs.select("doc_id", text_key().alias("key"))
    return join_rows(rows, leaks, ["doc_id", "key"], "left").select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast(f"array<{benchmark.schema['item_id'].dataType.simpleString()}>"))
        .alias("item_ids"), F.coalesce("containment", F.lit(0.0)).alias("containment"), "verbatim")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, with all their columns."""
    leaks = find_leaks(docs, benchmark).select("doc_id", F.col("key").alias("__dockey")).distinct()
    return join_rows(docs.withColumn("__dockey", text_key()), leaks, ["doc_id", "__dockey"],
                     "left_anti").drop("__dockey")
