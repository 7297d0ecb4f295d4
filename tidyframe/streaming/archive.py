"""Move a stream's input files away as soon as their batch is committed.

Spark's own ``cleanSource=archive`` moves a batch's files when the next batch starts, so the
last files stay until a later run finds new data.  Here the checkpoint says which
files each committed batch has read: exactly these are moved, right after the run.  Nothing is
globbed again, so a file that landed meanwhile stays for the next run.

A move is a rename on the file system, one per file.  A run that is killed between commit and
move leaves a note behind that is older than its commits; the next run moves the rest.  A file
of the same name that landed after the first was read has another modification time and stays.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "path string, timestamp bigint, batchId bigint"


def committed_files(spark: SparkSession, checkpoint: str, after: int = -1) -> DataFrame:
    """(path, timestamp, batchId) of the input files of committed batches later than ``after``,
    from the checkpoint's source log."""
    root = checkpoint.rstrip("/")
    try:
        lines = spark.read.text(f"{root}/sources/0")
        done = spark.read.text(f"{root}/commits").select(
            F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)$", 1).alias("batch")).distinct()
    except AnalysisException:  # no batch was ever planned, or none committed
        return spark.createDataFrame([], LOG_SCHEMA)
    entry = F.from_json("value", LOG_SCHEMA)
    found = lines.filter(F.startswith("value", F.lit("{"))).select(entry.alias("e")).select("e.*").distinct()
    done = done.filter("batch <> ''").select(F.col("batch").cast("bigint").alias("batchId"))
    # commits of long ago are cleaned up; what is below the newest one is committed
    newest = done.agg(F.max("batchId")).first()[0]
    return found.filter((F.col("batchId") > after) & (F.col("batchId") <= (-1 if newest is None else newest)))


def planned_files(spark: SparkSession, checkpoint: str, batch_id: int) -> list[str]:
    """Paths of the input files of a batch that is running, from the checkpoint's source log."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/sources/0")
    entries = lines.filter(F.startswith("value", F.lit("{"))).select(F.from_json("value", LOG_SCHEMA).alias("e"))
    found = entries.filter(F.col("e.batchId") == batch_id).select("e.path").distinct().toArrow()
    return sorted(found.column("path").to_pylist())


def _note(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}_archived"


def archive_committed(spark: SparkSession, checkpoint: str, archive_dir: str) -> int:
    """Move the files of committed batches under ``archive_dir``, each keeping its full path.
    Returns the number of files moved by this call."""
    try:
        after = int(spark.read.text(_note(checkpoint)).first()[0])
    except (AnalysisException, TypeError, ValueError):
        after = -1  # nothing archived yet, or a note that was never finished
    files = committed_files(spark, checkpoint, after).orderBy("batchId", "path").toArrow().to_pylist()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path_of = jvm.org.apache.hadoop.fs.Path
    moved = 0
    for f in files:
        source = path_of(jvm.java.net.URI(f["path"]))
        fs = source.getFileSystem(conf)
        if not fs.exists(source) or fs.getFileStatus(source).getModificationTime() != f["timestamp"]:
            continue  # moved before, or another file by now
        target = path_of(archive_dir.rstrip("/") + source.toUri().getPath())
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise RuntimeError(f"{source} could not be moved to {target}")
        moved += 1
    if files:
        last = max(f["batchId"] for f in files)
        spark.createDataFrame([(str(last),)], "value string").coalesce(1).write.mode("overwrite").text(_note(checkpoint))
    return moved
