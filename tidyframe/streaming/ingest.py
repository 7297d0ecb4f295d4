"""Incremental file ingest with archiving (Structured Streaming).

A file-source stream with a checkpoint owns the list of processed files, so

* a rerun reads only files it has not committed yet (exactly once: the file
  sink's metadata log and the checkpoint commit together);
* a file that lands while a run is going is picked up by this run or the next,
  never moved unread;
* ``cleanSource=archive`` moves processed files under ``archive_dir``.  Spark
  archives a batch's files when the *next* batch starts, so the newest files
  stay in place until a later run finds new data (harmless: the checkpoint
  already marks them as read).  Archived files keep their full source path
  under ``archive_dir``; the archive must not match the source glob.

``trigger(availableNow=True)`` processes everything present, in as many
micro-batches as ``max_files_per_batch`` allows, and stops: a batch job with
streaming bookkeeping.  Streams need an explicit schema.
"""

from __future__ import annotations

import base64
import datetime as dt
import json
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidyframe.errors import SpecError
from tidyframe.sinks.write import SinkSpec, write_sink, writer_options
from tidyframe.sources.read import read_source, reader_options
from tidyframe.sources.spec import SourceSpec, schema_from_files_ok
from tidyframe.streaming.archive import archive_committed
from tidyframe.streaming.key_index import KeyIndex
from tidyframe.streaming.ledger import LedgerStep

STREAM_SINK_FORMATS = ("parquet", "csv", "json")
OBSERVED = "tidyframe_ingest_rows"


#: a query keeps this many progress entries; by default Spark forgets all but the last 99
KEPT_PROGRESS = "spark.sql.streaming.numRecentProgressUpdates"


@contextmanager
def keeping_progress(spark: SparkSession):
    """A query run inside keeps the progress of every micro-batch."""
    before = spark.conf.get(KEPT_PROGRESS, None)
    spark.conf.set(KEPT_PROGRESS, str(2**31 - 1))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(KEPT_PROGRESS)
        else:
            spark.conf.set(KEPT_PROGRESS, before)


def rows_written(query: StreamingQuery) -> int:
    """Rows this run wrote: the observed counts of all its micro-batches."""
    return sum(int((p.observedMetrics or {})[OBSERVED]["rows"])
               for p in query.recentProgress if OBSERVED in (p.observedMetrics or {}))


def schema_from_files(spark: SparkSession, source: SourceSpec, checkpoint: str | None = None):
    """Schema of the files present now (CSV header / Parquet footers only).  It is kept
    beside ``checkpoint``, for a rerun when all files have been archived."""
    from pyspark.errors import AnalysisException

    kept = f"{checkpoint.rstrip('/')}_schema" if checkpoint else None
    try:
        found = read_source(spark, source).drop(*([source.file_path_col]
                                                  if source.file_path_col else [])).schema
    except AnalysisException as ex:
        try:
            if kept is not None:
                return StructType.fromJson(json.loads(spark.read.text(kept).first()[0]))
        except AnalysisException:
            pass  # a first run: nothing kept yet
        raise SpecError(
            f"no files at {source.path!r} to take the schema from; give source.schema"
        ) from ex
    if kept is not None:
        spark.createDataFrame([(found.json(),)], "value string").write.mode("overwrite").text(kept)
    return found


def new_files(spark: SparkSession, source: SourceSpec, archive_dir: str | None = None,
              max_files_per_batch: int | None = None, checkpoint: str | None = None) -> DataFrame:
    """Stream of the rows of every not-yet-seen file of ``source``."""
    if source.is_jdbc:
        raise SpecError("ingest reads files, not JDBC")
    if source.headers == "by_name":
        raise SpecError("a file stream has one schema: headers='by_name' is for batch jobs")
    schema = source.schema
    if schema is None:
        if not schema_from_files_ok(source):
            raise SpecError("ingest needs an explicit source schema for this format")
        schema = schema_from_files(spark, source, checkpoint)
    paths = list(source.path) if isinstance(source.path, tuple) else [source.path]
    if len(paths) != 1:
        raise SpecError("ingest reads one path or glob")

    reader = (spark.readStream.format(source.format).schema(schema)
              .options(**reader_options(source)))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    df = reader.load(paths[0])
    if source.file_path_col:
        df = df.withColumn(source.file_path_col, F.col("_metadata.file_path"))
    return df


def ingest_files(
    spark: SparkSession,
    source: SourceSpec,
    sink: SinkSpec,
    checkpoint: str,
    archive_dir: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    dedupe_keys: Sequence[str] | None = None,
    max_files_per_batch: int | None = None,
    watermark: tuple[str, str] | None = None,
    metrics: Callable[[DataFrame], Mapping[str, Column]] | None = None,
) -> StreamingQuery:
    """Process every not-yet-seen file of ``source`` into ``sink``; blocks.

    ``dedupe_keys`` keeps the first row seen per key, across runs.  Without a
    watermark every key ever seen stays in the checkpoint's state store (use
    the RocksDB provider for many keys).  With ``watermark=(event_time_col,
    "2 hours")`` duplicates are dropped while their copies arrive within that
    delay of each other and older keys leave the state, so it stays bounded
    (``dropDuplicatesWithinWatermark``).  ``metrics`` gives aggregates that are observed
    with the written rows of each micro-batch.
    """
    if sink.format not in STREAM_SINK_FORMATS:
        raise SpecError(f"ingest sink format must be one of {STREAM_SINK_FORMATS}")
    if sink.mode != "append":
        raise SpecError("ingest only appends; set sink mode to 'append'")
    df = new_files(spark, source, archive_dir, max_files_per_batch, checkpoint)
    if transform is not None:
        df = transform(df)
    if dedupe_keys and watermark:
        df = df.withWatermark(*watermark).dropDuplicatesWithinWatermark(list(dedupe_keys))
    elif dedupe_keys:
        df = df.dropDuplicates(list(dedupe_keys))
    elif watermark:
        raise SpecError("a watermark only applies to ingest dedupe")
    if sink.num_files and sink.num_files > 0:
        df = df.repartition(sink.num_files)
    # rows written per micro-batch, reported in the query's progress
    more = metrics(df) if metrics is not None else {}
    df = df.observe(OBSERVED, F.count(F.lit(1)).alias("rows"), *[e.alias(n) for n, e in more.items()])

    writer = (
        df.writeStream.format(sink.format)
        .options(**writer_options(sink))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if sink.partition_by:
        writer = writer.partitionBy(*sink.partition_by)
    with keeping_progress(spark):
        query = writer.start(sink.path)
        query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def _stream_log(spark: SparkSession, path: str) -> bool:
    """Does a file stream's log own ``path``?  Readers then see the log's files only."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.text(f"{path.rstrip('/')}/_spark_metadata")
    except AnalysisException:
        return False
    return True


def _of_batch(spark: SparkSession, small: DataFrame | None, batch_id: int) -> DataFrame | None:
    """A report (a row per column and metric) outlives its micro-batch, with ``batch_id``."""
    if small is None:
        return None
    kept = small.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    return spark.createDataFrame(kept.collect(), kept.schema)


def _run_batches(spark: SparkSession, spec, run_date: dt.date, run_ts: dt.datetime):
    """Each micro-batch of new files runs as a batch job of its own: clean, dedupe
    with its order, stamps, observed report, one write.

    A batch writes the folder ``ingest_batch=<query id>-<batch id>`` of the sink, and
    overwrites it when retried: exactly once for every format, whatever date the retry
    carries.  The query id lives in the checkpoint, so a new checkpoint never replaces
    an older one's batches.  Without ``max_files_per_batch`` a run is one batch (plus
    the retry of a failed one); with it, rows are de-duplicated within each batch.
    With ``content_ledger`` files that were read before under another name are left out (``ledger``).
    With ``unique_index`` rows whose key an earlier batch wrote are left out (``key_index``).
    The report has a ``batch_id``; kept reports and metric states are written in their
    batch, to folders named like the data's.
    """
    from tidyframe.plans.job import JobResult, keep_report, plan_job, write_quarantine
    from tidyframe.plans.quarantine import FILE, quarantined_source

    if _stream_log(spark, spec.sink.path):
        raise SpecError(f"{spec.sink.path!r} holds a file stream's log, which would hide new "
                        "batches from readers; give the job a sink of its own")
    done: list[JobResult] = []
    ing = spec.ingest
    source = quarantined_source(spec.source, spec.quarantine)
    if ing.content_ledger and source.file_path_col is None:
        source = replace(source, file_path_col=FILE)

    def one_batch(rows: DataFrame, batch_id: int) -> None:
        own = rows.sparkSession
        query_id = own.sparkContext.getLocalProperty("sql.streaming.queryId")
        sink = replace(spec.sink, mode="overwrite", dynamic_overwrite=False,
                       path=f"{spec.sink.path.rstrip('/')}/ingest_batch={query_id}-{batch_id}")
        name = f"{query_id}-{batch_id}"
        planned = step = files = None
        if ing.content_ledger:
            files = LedgerStep(ing.content_ledger, ing.checkpoint, batch_id, name, source.file_path_col)
            rows = files(rows)
            if source.file_path_col == FILE and spec.quarantine is None:
                rows = rows.drop(FILE)  # read for the ledger only
        if ing.unique_index:
            step = KeyIndex(ing.unique_index, spec.dedupe.keys, ing.unique_buckets, ing.unique_bits).step(name)
        try:
            planned = plan_job(own, replace(spec, sink=sink), run_date, run_ts, rows, step)
            write_quarantine(planned, name)
            write_sink(planned.frame, sink, layout=False)
            result = planned.result(own)
            for held in (step, files):
                if held is not None:
                    held.commit()
        finally:
            for held in (step, planned, files):
                if held is not None:
                    held.release()
        result.report, result.state = (_of_batch(spark, x, batch_id) for x in (result.report, result.state))
        done.append(keep_report(result, spec, name))

    stream = new_files(spark, source, None, ing.max_files_per_batch, ing.checkpoint)
    query = (stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", ing.checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    report = None
    if spec.quality is not None:
        empty = spark.createDataFrame(
            [], "check string, subject string, metric string, value double, batch_id bigint")
        report = reduce(DataFrame.unionByName, [r.report for r in done], empty)
    return JobResult(spec.sink.path, run_date, run_ts, sum(r.rows_written for r in done), report)


def _watermark_states(query: StreamingQuery, states, spark: SparkSession) -> tuple[DataFrame | None, int, int]:
    """(metric states of the run's micro-batches, last batch, rows too late for the
    watermark), from the query's progress."""
    found, last, late = None, -1, 0
    for p in query.recentProgress:
        seen = (p.observedMetrics or {}).get(OBSERVED)
        for op in p.stateOperators:
            late += op.numRowsDroppedByWatermark
        if seen is None or not p.numInputRows:
            continue
        dropped = sum(int(op.customMetrics.get("numDroppedDuplicateRows", 0)) for op in p.stateOperators)
        values = {**seen.asDict(), "__rows_before": int(seen["rows"]) + dropped}
        if "__key_sketch" in values:  # a progress is JSON: binary values come as base64
            values["__key_sketch"] = base64.b64decode(values["__key_sketch"])
        one = states.from_row(spark, values).withColumn("batch_id", F.lit(p.batchId).cast("bigint"))
        found, last = one if found is None else found.unionByName(one), max(last, p.batchId)
    return found, last, late


def run_incremental(spark: SparkSession, spec, run_date: dt.date, run_ts: dt.datetime):
    """``run_job`` for a spec with an ``ingest`` section.

    Rows are de-duplicated within a run, and with ``unique_index`` across runs
    (``_run_batches``).  With a watermark a file stream keeps the first row of each key,
    across the runs within its delay.  Its metrics are
    observed in every micro-batch and merged; rows that came too late for the watermark,
    which Spark drops, are counted (``watermark / n_late``).  With ``archive_dir`` the files of
    committed batches are moved before the run ends.
    """
    run = _run_watermark if spec.ingest.watermark_column else _run_batches
    if spec.ingest.archive_dir:  # what a run that was killed has left
        archive_committed(spark, spec.ingest.checkpoint, spec.ingest.archive_dir)
    result = run(spark, spec, run_date, run_ts)
    if spec.ingest.archive_dir:
        archive_committed(spark, spec.ingest.checkpoint, spec.ingest.archive_dir)
    return result


def _run_watermark(spark: SparkSession, spec, run_date: dt.date, run_ts: dt.datetime):
    from tidyframe.operators.metric_state import report_from_state, state_plan
    from tidyframe.plans.job import JobResult, _stamp, keep_report, transform_frame

    if spec.dedupe and spec.dedupe.order_by:
        raise SpecError(
            "dedupe within a watermark keeps the first row seen per key; order_by is not supported"
        )

    def transform(df: DataFrame) -> DataFrame:
        return _stamp(transform_frame(df, spec, run_date), spec, run_date, run_ts)

    q = spec.quality
    deduped = bool(q and spec.dedupe and set(q.keys) == set(spec.dedupe.keys))
    plans = []

    def metrics(df: DataFrame) -> dict[str, Column]:
        if q is None:
            return {}
        plan = state_plan(df, q.ranges, q.columns, q.keys, q.describe, "__rows_before" if deduped else None)
        # the counted rows before the dedupe come from the state store, not from this aggregate
        blank = spark.createDataFrame([], df.schema)
        plan.wide_schema = blank.agg(*plan.aggs, F.lit(0).cast("bigint").alias("__rows_before")).schema
        plans.append(plan)
        return plan.exprs

    ing = spec.ingest
    query = ingest_files(
        spark, spec.source, spec.sink, ing.checkpoint, None, transform,
        spec.dedupe.keys if spec.dedupe else None, ing.max_files_per_batch,
        (ing.watermark_column, ing.watermark_delay), metrics,
    )
    result = JobResult(spec.sink.path, run_date, run_ts, rows_written(query), None)
    if q is None:
        return result
    states, last, late = _watermark_states(query, plans[0], spark)
    if states is None:  # no new files: nothing to report, nothing to keep
        result.report = spark.createDataFrame([], "check string, subject string, metric string, value double")
        return result
    states = spark.createDataFrame(states.collect(), states.schema)  # a row per column and batch
    report = report_from_state(states, legacy_null_valid=q.legacy_null_valid)
    late_rows = spark.createDataFrame([("watermark", ing.watermark_column, "n_late", float(late))], report.schema)
    result.report, result.state = report.unionByName(late_rows), states
    return keep_report(result, spec, f"{query.id}-{last}")
