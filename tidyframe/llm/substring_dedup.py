"""Substring dedup by super-k-mers.

A window is ``WINDOW`` consecutive words; its minimiser is the least hash of the
``GRAM``-word grams in it.  Consecutive windows with one minimiser form a
super-k-mer: the string of their words, packed once, travels to the minimiser's
bucket, and equal windows always meet there.

1. Minimisers alone are counted first: one that occurs under a single document
   id can not hold a window found elsewhere, so only documents with shared
   minimisers send strings.
2. Equal super-k-mers of a task's chunk are collapsed to one string with the least
   document id before they travel, so a passage copied a million times is one row
   per chunk.
3. A bucket sorts the windows of its strings and takes the least document id of
   each distinct window; hashes only find the candidates, equality is checked word
   by word.  Windows are counted by minimiser first: of one with more than
   ``BUCKET_WINDOWS`` (a stock passage shorter than a window, with ever other words
   around it) each window travels alone, as its 128-bit code, dealt by that code, so
   that no group grows with the table, and only windows of more than one document id are
   answered.
4. Each text compares its own id with those of its windows, once for all places of equal
   strings in it (a text of few words over and over has the same windows hundreds of
   times); words under a window that also starts in a document with a smaller id are
   removed.

Defined results: null and empty texts keep nothing and lose nothing; texts under
``WINDOW`` words lose nothing; repeats inside one document id are not removed;
rows with a null id neither lose words nor make others lose any; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyframe.llm.common import (
    hash_words,
    join_rows,
    materialize,
    slices,
    split_words,
    text_key,
    utf8,
    window_hashes,
)

WINDOW = 50
GRAM = 16            # longer than a stock phrase: those would mark most documents as shared
BUCKET_WINDOWS = 200_000  # windows sorted at a time; a minimiser of more is dealt by window


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` consecutive ones, by doubling."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[:len(x) - (width - done)], x[width - done:]) if width > done else x


def _superkmers(grams: np.ndarray, window: int, gram: int):
    """(minimisers, first windows, ends): the runs of windows that share a minimiser,
    from the gram hashes of one text."""
    if len(grams) < window - gram + 1:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    least = _sliding_min(grams, window - gram + 1)
    cut = np.flatnonzero(least[1:] != least[:-1]) + 1
    first = np.concatenate([[0], cut])
    return least[first].astype(np.int64), first, np.append(cut, len(least))


def _each_text(part, window):
    ids, starts, words = split_words(part.column("text").to_pylist())
    gram = min(GRAM, window)
    grams = window_hashes(hash_words(words)[ids], gram)  # of the whole chunk at once
    for k in range(part.num_rows):
        a, b = starts[k], starts[k + 1]
        yield k, ids[a:b], words, _superkmers(grams[a:max(a, b - gram + 1)], window, gram)


def _minimisers(window: int):
    def run(batches):
        import pyarrow as pa

        for part in slices(batches):
            owner, found, windows = [], [], []
            for k, _, _, (least, first, end) in _each_text(part, window):
                own, which = np.unique(least, return_inverse=True)
                owner += [k] * len(own)
                found.append(own)
                windows.append(np.bincount(which, end - first, len(own)).astype(np.int64))
            found, windows = (np.concatenate([*x, np.empty(0, np.int64)]) for x in (found, windows))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(found, pa.int64()),
                 pa.array(windows, pa.int64())], names=["doc_id", "minimiser", "windows"])

    return run


def _strings(window: int, pack: bool):
    """Super-k-mers under shared minimisers: as strings, or as slim rows, one per text and
    distinct string with all places where it begins.  Under hot minimisers those of single
    windows, whose string is null."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        digest = xxhash.xxh3_128_intdigest
        for part in slices(batches):
            shared, hot, ids = (part.column(c).to_pylist() for c in ("shared", "hot", "doc_id"))
            at: dict = {}
            least_id: dict = {}
            for k, own, words, (least, first, end) in _each_text(part, window):
                use = np.flatnonzero(np.isin(least, np.array(shared[k], np.int64)))
                alone = np.isin(least, np.array(hot[k], np.int64))
                spans = [(int(least[j]), a, b, bool(alone[j])) for j in use.tolist()
                         for a, b in ([(a, a + 1) for a in range(first[j], end[j])] if alone[j]
                                      else [(int(first[j]), int(end[j]))])]
                for minimiser, a, b, single in spans:
                    text = b" ".join([words[w] for w in own[a:b + window - 1]])
                    code = digest(text)
                    key = (minimiser, (code >> 64) - (1 << 63), (code & (1 << 64) - 1) - (1 << 63))
                    if pack:
                        own_id = ids[k]
                        _, lo, hi = least_id.get(key, (None, own_id, own_id))
                        least_id[key] = (None if single else text, min(lo, own_id), max(hi, own_id))
                    else:
                        at.setdefault((*key, k), []).append(a)
            if pack:
                keys = [pa.array([key[k] for key in least_id], pa.int64()) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array([v[0] for v in least_id.values()], pa.binary()),
                     pa.array([v[1] for v in least_id.values()], pa.int64()),
                     pa.array([v[2] for v in least_id.values()], pa.int64())],
                    names=["minimiser", "code1", "code2", "packed", "least", "most"])
            else:
                *keys, owner = (pa.array([key[k] for key in at], pa.int64()) for k in range(4))
                yield pa.RecordBatch.from_arrays(
                    [*keys, part.column("doc_id").take(owner), part.column("row_no").take(owner),
                     pa.array(list(at.values()), pa.list_(pa.int64()))],
                    names=["minimiser", "code1", "code2", "doc_id", "row_no", "firsts"])

    return run


def _least_ids(packed: list[bytes], doc_ids: np.ndarray, window: int) -> list[np.ndarray]:
    """For each string, the least document id of each of its windows."""
    seen: dict[bytes, int] = {}
    rows = [np.array([seen.setdefault(w, len(seen)) for w in p.split(b" ")], np.int64) for p in packed]
    per = [len(r) - window + 1 for r in rows]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    words = np.concatenate(rows)
    at = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, per, strict=False)])
    code = window_hashes(hash_words(seen)[words], window)[at]
    _, group = np.unique(code, return_inverse=True)
    example = np.empty(group.max() + 1, np.int64)
    example[group] = at
    differ = np.zeros(len(at), bool)
    for k in range(window):  # equal hashes must be equal windows, word by word
        differ |= words[at + k] != words[example[group] + k]
    if differ.any():  # a collision: sort the windows themselves
        all_ = np.lib.stride_tricks.sliding_window_view(words, window)[at]
        _, group = np.unique(all_, axis=0, return_inverse=True)
        group = group.ravel()
    least = np.full(group.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, np.repeat(doc_ids, per))
    return np.split(least[group], np.cumsum(per)[:-1])


def _buckets(window: int):
    """Rows sorted by minimiser and code -> the same strings' codes with their windows' ids."""

    def answer(rows):
        import pyarrow as pa

        # a window of one document id takes no word: it needs no answer
        alone = [r for r in rows if r[3] is None and r[4] < r[5]]
        rows = [r for r in rows if r[3] is not None]
        least = _least_ids([r[3] for r in rows], np.array([r[4] for r in rows], np.int64), window) if rows else []
        rows, least = rows + alone, [*least, *([r[4]] for r in alone)]
        return pa.RecordBatch.from_arrays(
            [*(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)),
             pa.array(least, pa.list_(pa.int64()))], names=["minimiser", "code1", "code2", "least"])

    def run(batches):
        held, windows = [], 0
        for part in batches:
            cols = [part.column(c).to_pylist() for c in ("minimiser", "code1", "code2", "packed", "least", "most")]
            for row in zip(*cols, strict=True):
                if held and row[:3] == held[-1][:3]:  # the least and the greatest id of equal strings
                    held[-1] = (*row[:4], min(held[-1][4], row[4]), max(held[-1][5], row[5]))
                    continue
                if windows >= BUCKET_WINDOWS and (row[3] is None or row[0] != held[-1][0]):
                    yield answer(held)
                    held, windows = [], 0
                held.append(row)
                windows += 1 if row[3] is None else row[3].count(b" ") + 2 - window
        if held:
            yield answer(held)

    return run


def _result(part, texts, keeps, with_text: bool, names=("doc_id",)):
    import pyarrow as pa

    n, gone, code, left = [], [], [], []
    for text, keep in zip(texts, keeps, strict=True):
        if text is None:  # still to be judged
            n.append(None), gone.append(None), code.append(None), left.append(None)
            continue
        words = utf8(text).split()
        kept = words if keep is None else [w for w, k in zip(words, keep(len(words)).tolist(), strict=True) if k]
        joined = b" ".join(kept)
        n.append(len(words))
        gone.append(len(words) - len(kept))
        code.append(hashlib.sha256(joined).hexdigest())
        left.append(joined.decode("utf-8", "replace") if with_text else None)
    return [*(part.column(c) for c in names), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
            pa.array(code, pa.string()), pa.array(left, pa.string())]


_OUT = ["n_words", "n_removed", "kept_sha256", "kept_text"]


def _settle(with_text: bool):
    """Rows without shared minimisers are done; of the others the text goes on."""

    def run(batches):
        import pyarrow as pa

        for part in slices(batches):
            texts, shared = part.column("text").to_pylist(), part.column("shared").to_pylist()
            done = [(t or "") if s is None else None for t, s in zip(texts, shared, strict=True)]
            on = pa.array([t if s is not None else None for t, s in zip(texts, shared, strict=True)], pa.string())
            cols = _result(part, done, [None] * len(done), with_text)
            yield pa.RecordBatch.from_arrays([*cols, on, part.column("shared"), part.column("hot")],
                                             names=["doc_id", *_OUT, "text", "shared", "hot"])

    return run


def _finish(window: int, with_text: bool):
    def run(batches):
        import pyarrow as pa

        def keep(spans):
            def mask(n):
                edge = np.zeros(n + 1, np.int64)
                for s in spans or []:
                    at = np.add.outer(np.array(s["firsts"], np.int64), np.array(s["hits"], np.int64)).ravel()
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
                return np.cumsum(edge)[:-1] == 0
            return mask

        for part in slices(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            keeps = [keep(s) for s in part.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays(_result(part, texts, keeps, with_text), names=["doc_id", *_OUT])

    return run


def dedup_substrings(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_words, n_removed, kept_sha256, kept_text (the
    kept words joined by one space; null unless ``with_text``): one row per row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text")
    least = materialize(rows.filter("doc_id IS NOT NULL").mapInArrow(
        _minimisers(window), f"doc_id {id_type}, minimiser long, windows long"), "minimisers")
    shared = (least.groupBy("minimiser").agg(
        F.min("doc_id").alias("a"), F.max("doc_id").alias("b"),
        (F.sum("windows") > BUCKET_WINDOWS).alias("is_hot"))
        .filter("a < b").select("minimiser", "is_hot"))
    per_doc = least.select("doc_id", "minimiser").join(shared, "minimiser").groupBy("doc_id").agg(
        F.collect_set("minimiser").alias("shared"),
        F.collect_set(F.when(F.col("is_hot"), F.col("minimiser"))).alias("hot"))
    out = f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string, kept_text string"
    settled = materialize(
        rows.join(per_doc, "doc_id", "left").mapInArrow(
            _settle(with_text), f"{out}, text string, shared array<long>, hot array<long>")
        .withColumn("row_no", F.monotonically_increasing_id()), "substring-docs")

    some = settled.filter("shared IS NOT NULL").select("doc_id", "row_no", "text", "shared", "hot")
    packed = some.mapInArrow(
        _strings(window, True), "minimiser long, code1 long, code2 long, packed binary, least long, most long")
    deal = F.when(F.col("packed").isNull(), F.col("code1"))
    answers = (packed.repartition("minimiser", deal)
               .sortWithinPartitions("minimiser", "code1", "code2").mapInArrow(
        _buckets(window), "minimiser long, code1 long, code2 long, least array<long>"))
    places = some.mapInArrow(
        _strings(window, False),
        f"minimiser long, code1 long, code2 long, doc_id {id_type}, row_no long, firsts array<long>")
    hits = F.filter(F.transform("least", lambda x, i: F.when(x < F.col("doc_id"), i)),
                    lambda i: i.isNotNull())
    spans = (places.join(answers, ["minimiser", "code1", "code2"])
             .select("row_no", "firsts", hits.alias("hits")).filter("size(hits) > 0")
             .groupBy("row_no").agg(F.collect_list(F.struct("firsts", "hits")).alias("spans")))
    judged = (some.select("row_no", "doc_id", "text").join(spans, "row_no", "left")
              .select("doc_id", "text", "spans").mapInArrow(_finish(window, with_text), out))
    return settled.filter("shared IS NULL").select("doc_id", *_OUT).unionByName(judged)
