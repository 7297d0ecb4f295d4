"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyframe.session import scratch_path

#: a word: a run of anything but space, tab, line feed, VT, FF, CR
WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder, reread it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(col: str = "text") -> Column:
    """64-bit hash that tells rows of one id with different texts apart."""
    return F.xxhash64(F.coalesce(F.col(col), F.lit("")), F.col(col).isNull())


def join_rows(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that takes null as a value; ``on`` comes from the left."""
    own = {c: f"__{c}" for c in on}
    right = right.withColumnsRenamed(own)
    cond = None
    for c in on:
        one = F.col(c).eqNullSafe(F.col(own[c]))
        cond = one if cond is None else cond & one
    return left.join(right, cond, how).drop(*own.values())


# ---------------------------------------------------------------- inside tasks


def utf8(text) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def slices(batches, column: str = "text", max_bytes: int = CHUNK_BYTES):
    """Cut record batches so that a slice's ``column`` holds about ``max_bytes``
    (one longer text makes a slice of its own)."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        part = np.cumsum(sizes) // max_bytes
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(int(a), int(b - a))


def split_words(texts, lower: bool = False):
    """(ids, starts, words): the words of all texts as numbers in one array,
    text k's being ``ids[starts[k]:starts[k + 1]]``; ``words`` lists the
    distinct words as UTF-8 bytes.  ``lower`` folds A-Z only."""
    seen: defaultdict = defaultdict()
    seen.default_factory = seen.__len__
    ids: list[int] = []
    starts = [0]
    for text in texts:
        raw = utf8(text)
        ids += [seen[w] for w in (raw.lower() if lower else raw).split()]
        starts.append(len(ids))
    return np.array(ids, dtype=np.int64), np.array(starts, dtype=np.int64), list(seen)


def hash_words(words) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Order-dependent 64-bit hash of each ``width`` consecutive word hashes."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out, mixed = np.zeros(n, dtype=np.uint64), mix64(h)
    factor = 1
    for k in range(width):
        out += mixed[k:k + n] * np.uint64(factor)
        factor = (factor * 0x9E3779B97F4A7C15) % (1 << 64)
    return mix64(out)
