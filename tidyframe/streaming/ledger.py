"""Input files that were read before under another name are not read again.

The checkpoint knows files by path; a file that arrives twice under two names would be ingested
twice.  The ledger keeps the SHA-256 of every file of every finished batch.  A batch's
files are hashed in the cluster (one more read of their bytes), compared with the ledger and with
each other, and the rows of those that repeat are left out; the first by path stays.

A batch's digests are written after its rows, in a folder of the batch's own, so a failed
batch leaves nothing that its retry would trip over.  A file is hashed whole in one task's
memory: Spark refuses files of 2 GB and more here.  Empty files repeat each other, which is
harmless.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidyframe.streaming.archive import planned_files

LEDGER_SCHEMA = "file string, length bigint, digest string"


def file_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, length, digest) of files given as the checkpoint names them."""
    literal = [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(p)) for p in paths]
    if not literal:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.format("binaryFile").load(literal).select(
        F.col("_metadata.file_path").alias("file"), "length", F.sha2("content", 256).alias("digest"))


class LedgerStep:
    """One batch's use of the ledger: call it on the batch's rows, write them, ``commit``."""

    def __init__(self, path: str, checkpoint: str, batch_id: int, batch: str, file_col: str):
        self.path, self.checkpoint, self.batch_id = path.rstrip("/"), checkpoint, batch_id
        self.batch, self.file_col = batch, file_col
        self.digests: DataFrame | None = None
        self.repeated: list[str] = []

    def _others(self, spark: SparkSession) -> DataFrame | None:
        try:
            kept = spark.read.schema(f"{LEDGER_SCHEMA}, ingest_batch string").parquet(self.path)
        except AnalysisException:
            return None
        return kept.filter(F.col("ingest_batch") != self.batch)

    def __call__(self, rows: DataFrame) -> DataFrame:
        spark = rows.sparkSession
        files = planned_files(spark, self.checkpoint, self.batch_id)
        self.digests = file_digests(spark, files).persist()  # a row per file, hashed once
        first = F.row_number().over(Window.partitionBy("digest", "length").orderBy("file"))
        again = self.digests.withColumn("n", first).filter("n > 1").select("file")
        known = self._others(spark)
        if known is not None:
            seen = known.select("digest", "length").distinct()
            again = again.union(self.digests.join(seen, ["digest", "length"], "left_semi").select("file"))
        self.repeated = sorted({r["file"] for r in again.collect()})  # names of files
        return rows.filter(~F.col(self.file_col).isin(self.repeated)) if self.repeated else rows

    def commit(self) -> None:
        self.digests.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ingest_batch={self.batch}")
        self.release()

    def release(self) -> None:
        if self.digests is not None:
            self.digests.unpersist()
