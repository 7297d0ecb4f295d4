"""Rows unique across runs: an index of the keys that earlier batches have written.

The index is two tables in one folder:

* ``keys/ingest_batch=<batch>/bucket=<b>``: the keys that a batch was the first to write,
  by hash bucket;
* ``filter0`` and ``filter1``: a Bloom filter per bucket over the keys of all batches.  Batches
  overwrite the two in turn, so one of them is whole at any time.

A batch asks the filters first.  Rows whose key no filter holds are new without any join;
the others are anti-joined with the keys of the buckets that may hold theirs, and Spark reads
only these buckets' folders.  The batch's rows are written before its keys, and its keys before
its filter; a retry ignores what its first attempt left and overwrites it, so a batch that
failed anywhere counts once.  If no filter is whole it is rebuilt from the keys.

A batch holds one row per key (its dedupe reduces a hot key in the map tasks) and buckets go by
a hash of the key, so no bucket collects copies.  Filters take ``buckets * bits / 8`` bytes,
fixed when the index is made; when they fill up, more buckets are read, results stay.
One job at a time may write to an index.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyframe.errors import SpecError, require_columns
from tidyframe.functions._util import col, type_of
from tidyframe.operators._sql import quote_ident

HASH, BUCKET, MAYBE = "__index_hash", "bucket", "__index_maybe"
PROBES = 4
BROADCAST_BYTES = 32 << 20   # filters up to this size are sent to every task
FILTER_SCHEMA = "bucket int, words array<bigint>, seq bigint, batch string, buckets int, bits int"


@dataclass(frozen=True)
class KeyIndex:
    """``buckets`` and ``bits`` (of a bucket's filter) are fixed when the index is made: about
    ten bits a key keep the share of needless reads near one in a hundred."""

    path: str
    keys: tuple[str, ...]
    buckets: int = 256
    bits: int = 1 << 16

    def __post_init__(self):
        if not self.keys:
            raise SpecError("a key index needs keys")
        if self.buckets < 1 or self.bits < 64 or self.bits % 64:
            raise SpecError("a key index needs buckets >= 1 and bits as a multiple of 64")

    # ------------------------------------------------------------------ columns

    def _hashed(self, rows: DataFrame) -> DataFrame:
        require_columns(rows, self.keys)
        h = F.xxhash64(*[col(k) for k in self.keys])
        return rows.withColumn(HASH, h).withColumn("__index_bucket", F.pmod(F.col(HASH), F.lit(self.buckets)).cast("int"))

    def _probes(self) -> list[Column]:
        return [F.pmod(F.xxhash64(F.col(HASH), F.lit(i)), F.lit(self.bits)).cast("int") for i in range(PROBES)]

    # ------------------------------------------------------------------- tables

    def _keys_of_others(self, spark: SparkSession, rows: DataFrame, batch: str) -> DataFrame | None:
        fields = [f"{quote_ident(f'k{i}')} {type_of(rows, k).simpleString()}" for i, k in enumerate(self.keys)]
        schema = ", ".join([*fields, f"{HASH} bigint", f"{BUCKET} int", "ingest_batch string"])
        try:
            kept = spark.read.schema(schema).parquet(f"{self.path.rstrip('/')}/keys")
        except AnalysisException:
            return None  # no batch has written keys yet
        return kept.filter(F.col("ingest_batch") != batch)

    def _filters(self, spark: SparkSession, batch: str) -> list[tuple[int, int, DataFrame]]:
        """(sequence number, slot, rows) of the whole filters that other batches wrote."""
        found = []
        for slot in range(2):
            try:
                rows = spark.read.schema(FILTER_SCHEMA).parquet(f"{self.path.rstrip('/')}/filter{slot}")
            except AnalysisException:
                continue
            one = rows.agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("seq"), F.max("batch").alias("batch"),
                           F.max("buckets").alias("buckets"), F.max("bits").alias("bits")).first()
            if one["n"] and (one["buckets"], one["bits"]) != (self.buckets, self.bits):
                raise SpecError(f"the index at {self.path!r} was made with buckets={one['buckets']}, "
                                f"bits={one['bits']}")
            if one["n"] == self.buckets and one["batch"] != batch:
                found.append((one["seq"], slot, rows))
        return sorted(found, key=lambda f: f[0])

    def _words(self, hashed: DataFrame) -> DataFrame:
        """Set bits of the rows' hashes as (bucket, word, value)."""
        p = F.col("__position")
        return (hashed.select(F.col("__index_bucket").alias(BUCKET), F.explode(F.array(*self._probes())).alias("__position"))
                .groupBy(BUCKET, F.shiftright(p, 6).alias("word"))
                .agg(F.expr("bit_or(shiftleft(1L, __position & 63))").alias("value")))

    def _filter_of(self, words: DataFrame) -> DataFrame:
        """(bucket, words) for every bucket, all words in their order."""
        spark = words.sparkSession
        zeros = spark.range(self.buckets).select(
            F.col("id").cast("int").alias(BUCKET),
            F.explode(F.sequence(F.lit(0), F.lit(self.bits // 64 - 1))).alias("word"), F.lit(0).cast("bigint").alias("value"))
        every = words.unionByName(zeros).groupBy(BUCKET, "word").agg(F.expr("bit_or(value)").alias("value"))
        in_order = F.array_sort(F.collect_list(F.struct("word", "value")))
        return every.groupBy(BUCKET).agg(F.transform(in_order, lambda x: x["value"]).alias("words"))

    def current_filter(self, rows: DataFrame, batch: str) -> DataFrame | None:
        """(bucket, words) over the keys of all other batches; None if there are none."""
        spark = rows.sparkSession
        whole = self._filters(spark, batch)
        if whole:
            return whole[-1][2].select(BUCKET, "words")
        kept = self._keys_of_others(spark, rows, batch)
        if kept is None or kept.isEmpty():
            return None
        return self._filter_of(self._words(kept.withColumn("__index_bucket", F.col(BUCKET))))

    # -------------------------------------------------------------------- steps

    def step(self, batch: str) -> IndexStep:
        return IndexStep(self, batch)


class IndexStep:
    """One batch's use of the index: call it on the batch's rows (one per key) for those that
    are new, write them, then ``commit``."""

    def __init__(self, index: KeyIndex, batch: str):
        self.index, self.batch = index, batch
        self.judged: DataFrame | None = None
        self.fresh: DataFrame | None = None

    def __call__(self, rows: DataFrame) -> DataFrame:
        ix = self.index
        hashed = ix._hashed(rows)
        known = ix.current_filter(rows, self.batch)
        if known is None:
            maybe = hashed.withColumn(MAYBE, F.lit(False))
        else:
            known = known.withColumnsRenamed({BUCKET: "__index_bucket", "words": "__index_words"})
            if ix.buckets * ix.bits // 8 <= BROADCAST_BYTES:
                known = F.broadcast(known)
            bits = [F.getbit(F.get(F.col("__index_words"), F.shiftright(p, 6)), p.bitwiseAND(F.lit(63))) == 1
                    for p in ix._probes()]
            hit = bits[0]
            for b in bits[1:]:
                hit = hit & b
            maybe = hashed.join(known, "__index_bucket").withColumn(MAYBE, hit).drop("__index_words")
        # read by the touched buckets' list, by both branches and by the commit
        self.judged = maybe.persist(StorageLevel.DISK_ONLY)
        unseen = self.judged.filter(~F.col(MAYBE))
        if known is None:
            self.fresh = unseen
        else:
            doubtful = self.judged.filter(MAYBE)
            touched = [r[0] for r in doubtful.select("__index_bucket").distinct().collect()]  # at most `buckets`
            kept = ix._keys_of_others(rows.sparkSession, rows, self.batch)
            if not touched or kept is None:
                self.fresh = unseen.unionByName(doubtful)
            else:
                kept = kept.filter(F.col(BUCKET).isin(touched)).withColumnRenamed(HASH, "__kept_hash")
                same = F.col(HASH) == F.col("__kept_hash")
                for i, k in enumerate(ix.keys):
                    same = same & col(k).eqNullSafe(F.col(f"k{i}"))
                kept = kept.select("__kept_hash", *(f"k{i}" for i in range(len(ix.keys))))
                clash = [c for c in kept.columns if c in rows.columns]
                if clash:
                    raise SpecError(f"column name(s) {clash} are reserved by the key index")
                self.fresh = unseen.unionByName(doubtful.join(kept, same, "left_anti"))
        return self.fresh.drop(HASH, "__index_bucket", MAYBE)

    def total(self, count_col: str | None) -> int:
        """Rows of the batch, or the sum of ``count_col`` over them, seen or not."""
        n = F.count(F.lit(1)) if count_col is None else F.coalesce(F.sum(col(count_col)), F.lit(0))
        return int(self.judged.agg(n).first()[0])

    def commit(self) -> None:
        """Add the new keys; call when the batch's rows are written."""
        ix, spark, path = self.index, self.fresh.sparkSession, self.index.path.rstrip("/")
        (self.fresh.select(*[col(k).alias(f"k{i}") for i, k in enumerate(ix.keys)], HASH,
                           F.col("__index_bucket").alias(BUCKET))
         .repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET)
         .parquet(f"{path}/keys/ingest_batch={self.batch}"))
        whole = ix._filters(spark, self.batch)
        words = ix._words(self.fresh)
        before = ix.current_filter(self.fresh, self.batch)
        if before is not None:
            words = words.unionByName(before.select(BUCKET, F.posexplode("words").alias("word", "value")))
        seq, slot = (whole[-1][0] + 1, 1 - whole[-1][1]) if whole else (0, 0)
        (ix._filter_of(words).select(
            BUCKET, "words", F.lit(seq).cast("bigint").alias("seq"), F.lit(self.batch).alias("batch"),
            F.lit(ix.buckets).alias("buckets"), F.lit(ix.bits).alias("bits"))
         .write.mode("overwrite").parquet(f"{path}/filter{slot}"))
        self.release()

    def release(self) -> None:
        if self.judged is not None:
            self.judged.unpersist()


def unique_across_batches(rows: DataFrame, path: str, keys: Sequence[str], batch: str, write, **settings) -> None:
    """Pass the rows whose key no earlier batch had (one row per key in ``rows``) to
    ``write``, then enter their keys under ``batch``."""
    step = KeyIndex(path, tuple(keys), **settings).step(batch)
    try:
        write(step(rows))
        step.commit()
    finally:
        step.release()
