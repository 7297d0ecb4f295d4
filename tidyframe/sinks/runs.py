"""Appends that may be repeated: each run's rows count once, whatever failed on the way.

A plain append is not idempotent: a job that is run again, or that failed after some of its files
were committed, leaves rows twice.  Here a run writes a folder of its own,
``data/run_id=<run>/attempt=<uuid>``, and then appends one line to the manifest
(``_manifest``).  Readers take, of every run, the attempt that its last line names; an attempt
without a line was never finished.  The line is one small file that appears at once, so a
reader sees a run's old rows or its new ones, never both and never a part.

Partition pruning works as ever: runs and attempts are folders, the manifest has a row per run.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidyframe.errors import SpecError
from tidyframe.sinks.write import SinkSpec, write_sink, writer_options
from tidyframe.sources.read import READ_DEFAULTS

MANIFEST_SCHEMA = "run_id string, attempt string, committed_at string"
OWN_COLUMNS = ("run_id", "attempt")


def _folder(sink: SinkSpec) -> str:
    return sink.path.rstrip("/")


def append_run(df: DataFrame, sink: SinkSpec, run_id: str, layout: bool = True) -> None:
    """Append ``df`` as the rows of ``run_id``, in place of what an earlier attempt at the same
    run appended."""
    if not run_id or any(c in run_id for c in "/\\\0"):
        raise SpecError(f"a run id is a folder name, got {run_id!r}")
    clash = [c for c in df.columns if c.lower() in OWN_COLUMNS]
    if clash:
        raise SpecError(f"column name(s) {clash} are the run folders' own")
    spark, attempt = df.sparkSession, uuid.uuid4().hex
    target = replace(sink, mode="error", dynamic_overwrite=None, idempotent=False,
                     path=f"{_folder(sink)}/data/run_id={run_id}/attempt={attempt}")
    write_sink(df, target, layout=layout)
    now = dt.datetime.now(dt.timezone.utc).isoformat(timespec="microseconds")
    line = spark.createDataFrame([(run_id, attempt, now)], MANIFEST_SCHEMA).coalesce(1)
    line.write.mode("append").json(f"{_folder(sink)}/_manifest")


def committed_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, attempt, committed_at): the attempt that counts of every finished run."""
    try:
        lines = spark.read.schema(MANIFEST_SCHEMA).json(f"{path.rstrip('/')}/_manifest")
    except AnalysisException:
        lines = spark.createDataFrame([], MANIFEST_SCHEMA)
    last = F.max(F.struct("committed_at", "attempt")).alias("last")
    return lines.groupBy("run_id").agg(last).select("run_id", "last.attempt", "last.committed_at")


def read_runs(spark: SparkSession, sink: SinkSpec, schema: str | StructType, with_run_id: bool = False) -> DataFrame:
    """The rows of all committed runs of ``sink``.  ``schema``: the rows', without run folders."""
    data = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = StructType([*data.fields]).add("run_id", "string").add("attempt", "string")
    options = {**READ_DEFAULTS.get(sink.format, {}), **writer_options(sink)}
    options.pop("maxRecordsPerFile", None)
    try:
        rows = spark.read.format(sink.format).options(**options).schema(full).load(f"{_folder(sink)}/data")
    except AnalysisException:
        rows = spark.createDataFrame([], full)  # no run yet
    runs = committed_runs(spark, sink.path).select(*OWN_COLUMNS)
    rows = rows.join(runs, list(OWN_COLUMNS), "left_semi")
    names = [f.name for f in data.fields] + (["run_id"] if with_run_id else [])
    return rows.select(*[F.col("`" + n.replace("`", "``") + "`") for n in names])
