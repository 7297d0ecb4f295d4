"""Compile a ``JobSpec`` into ONE lazy plan and run it with ONE write.

Batch flow::

    read -> clean (text, dates, split) -> cast -> years -> dedupe -> stamps
         -> layout -> observe(metrics) -> write

* The quality metrics (completeness, statistics, ranges, rows before/after
  de-duplication) are collected by an ``Observation`` during the write itself.
  The observation sits *after* the last exchange, i.e. in the result stage,
  whose accumulator updates Spark applies once per partition even when tasks
  are retried or executors are lost.
* The dedupe carries each key's input row count, so the duplicate report needs
  no second pass.  Only when no dedupe runs on the quality key (or the order
  needs the window strategy) is the duplicate check a separate, pre-aggregated
  job -- or, with ``quality.approx_duplicates``, a HyperLogLog++ estimate in
  the same observation.
* ``plan_job`` returns the exact frame that will be written, so
  ``plan_job(...).frame.explain()`` shows the job's physical plan.
* With a quality section, each converted column (cast, date re-format, cast split
  part, year difference) gets a "nulled by the conversion" bit, set right after the row-local steps and
  packed into one bigint per 62 columns; the observation counts the bits of
  the written rows (``conversion / n_nulled`` in the report).  Only the mask,
  not the raw values, crosses the dedupe shuffle.
* The run date / timestamp are fixed once on the driver and written as
  literals, so retries and reruns stamp identical values.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidyframe.functions.casting import cast_columns, safe_cast
from tidyframe.functions.dates import reformat_date, years_between
from tidyframe.functions.split import split_column
from tidyframe.functions.stamps import add_run_stamps, run_clock
from tidyframe.functions.text import normalize_text, strip_accents, title_case, title_case_plain
from tidyframe.errors import SpecError, require_columns
from tidyframe.functions._util import col, is_temporal, own_name
from tidyframe.operators.dedupe import aggregatable, keep_one
from tidyframe.operators.metric_state import state_plan
from tidyframe.operators.quality import (
    MetricPlan,
    duplicate_metrics,
    duplicates_shape,
    quality_plan,
    report_from_parts,
)
from tidyframe.plans.quarantine import Quarantine, judge, keep_source, quarantined_source
from tidyframe.plans.spec import JobSpec
from tidyframe.sinks.runs import append_run
from tidyframe.sinks.write import prepare_layout, write_sink
from tidyframe.sources.read import read_source
from tidyframe.streaming.key_index import IndexStep

ROWS_COL = "__rows_per_key"
RAW_PREFIX = "__raw_"
MASK_PREFIX = "__nulled_mask_"
MASK_BITS = 62


@dataclass
class JobResult:
    output_path: str
    run_date: dt.date
    run_ts: dt.datetime
    rows_written: int | None
    report: DataFrame | None  # (check, subject, metric, value)
    rejected: dict[str, int] | None = None  # counts of the quarantine: read, accepted, by reason
    state: DataFrame | None = None  # metric states (``operators.metric_state``), if kept


# ------------------------------------------------------------------ transforms


def clean_frame(
    df: DataFrame, spec: JobSpec, counted: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, str]]:
    """Text / date / split steps.  Returns the frame and the date pattern each
    re-formatted column now has (for later year differences).  Split parts in
    ``counted`` keep a raw copy from before their cast."""
    c = spec.clean
    uni = c.unicode_whitespace
    exprs = {}
    for name in c.normalize_text:
        exprs[name] = normalize_text(exprs.get(name, col(name)), uni)
    for name in c.title_case:
        exprs[name] = title_case(exprs.get(name, col(name)), uni)
    for name in c.title_case_plain:
        exprs[name] = title_case_plain(exprs.get(name, col(name)), uni)
    for name in c.strip_accents:
        exprs[name] = strip_accents(exprs.get(name, col(name)))
    patterns = {}
    for r in c.reformat_date:
        require_columns(df, [r.column])
        src_pattern = None if is_temporal(df, r.column) else r.from_pattern
        exprs[r.column] = reformat_date(exprs.get(r.column, col(r.column)),
                                        src_pattern, r.to_pattern, r.on_error)
        patterns[r.column] = r.to_pattern
    require_columns(df, list(exprs))
    out = df.withColumns(exprs) if exprs else df
    for s in c.split:
        watched = [n for n in s.into if n in counted]
        out = split_column(out, s.column, list(s.into), s.pattern, s.regex,
                           s.keep_source, None if watched else s.cast, s.on_error)
        if watched:
            out = _keep_raw(out, watched)
            if s.cast is not None:
                out = out.withColumns({n: safe_cast(n, s.cast, s.on_error) for n in s.into})
    return out, patterns


def transform_frame(
    df: DataFrame, spec: JobSpec, run_date: dt.date, counted: Sequence[str] = ()
) -> DataFrame:
    """Every row-local step of the job (safe for batch and streaming).  Columns in
    ``counted`` that a step derives get a raw copy from before their conversion."""
    out, patterns = clean_frame(df, spec, counted)
    for step in spec.cast:
        out = cast_columns(out, list(step.columns), step.to, step.on_error, step.missing)
    for y in spec.years_between:
        pattern = y.pattern or patterns.get(y.start)
        if y.start in out.columns and is_temporal(out, y.start):
            pattern = None  # already a date / timestamp: nothing to parse
        end = y.end if y.end is not None else run_date
        years = years_between(y.start, end, pattern, y.method, y.on_error)
        if y.column in counted:  # "raw" is there when both ends hold a value
            ends = [own_name(out, v) for v in (y.start, end) if isinstance(v, str)]
            given = F.coalesce(*[F.when(col(c).isNull(), F.lit(False)) for c in ends if c], F.lit(True))
            out = out.withColumn(RAW_PREFIX + y.column, F.when(given, F.lit(1)))
        out = out.withColumn(y.column, years)
    return out


def _stamp(df: DataFrame, spec: JobSpec, run_date, run_ts) -> DataFrame:
    if spec.stamps is None:
        return df
    s = spec.stamps
    return add_run_stamps(df, run_date, run_ts, s.date_column, s.ts_column, s.ts_type)


def stamp_columns(spec: JobSpec) -> tuple[str, ...]:
    s = spec.stamps
    return tuple(c for c in (s.date_column, s.ts_column) if c) if s else ()


def build_frame(
    spark: SparkSession,
    spec: JobSpec,
    run_date: dt.date | None = None,
    run_ts: dt.datetime | None = None,
) -> DataFrame:
    """The job's output as a lazy DataFrame (no write, no metrics)."""
    if run_date is None or run_ts is None:
        run_date, run_ts = run_clock(run_ts)
    df = transform_frame(read_source(spark, spec.source), spec, run_date)
    if spec.dedupe:
        df = keep_one(df, spec.dedupe.keys, spec.dedupe.order_by, spec.dedupe.strategy)
    return _stamp(df, spec, run_date, run_ts)


# ------------------------------------------------------------------------- run


def converted_columns(spec: JobSpec) -> list[str]:
    """Columns a step converts: date re-formats, casts, cast split parts, years."""
    out = [r.column for r in spec.clean.reformat_date]
    out += [c for step in spec.cast for c in step.columns]
    out += [c for s in spec.clean.split if s.cast is not None for c in s.into]
    out += [y.column for y in spec.years_between]
    return list(dict.fromkeys(out))


def _keep_raw(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raw copies of the columns the frame has (a cast may skip missing ones)."""
    own = {own_name(df, c) for c in columns} - {None}
    return df.withColumns({RAW_PREFIX + c: col(c) for c in own}) if own else df


def _nulled_masks(df: DataFrame, converted: list[str]) -> DataFrame:
    """Replace the raw copies by bit masks: bit j of mask k says "the
    conversion of column ``converted[k*MASK_BITS + j]`` turned a value into
    NULL".  Computed before any shuffle, so only 8 bytes per row (per 62
    columns) travel to the observation instead of the raw values."""
    masks = {}
    for k in range(0, len(converted), MASK_BITS):
        bits = [
            F.when(col(RAW_PREFIX + c).isNotNull() & col(c).isNull(), F.lit(1 << j))
            .otherwise(F.lit(0)).cast("bigint")
            for j, c in enumerate(converted[k:k + MASK_BITS])
        ]
        total = bits[0]
        for b in bits[1:]:
            total = total + b
        masks[f"{MASK_PREFIX}{k // MASK_BITS}"] = total
    return df.withColumns(masks).drop(*[RAW_PREFIX + c for c in converted])


def _nulled_count(i: int) -> Column:
    mask = F.col(f"{MASK_PREFIX}{i // MASK_BITS}")
    return F.count_if(mask.bitwiseAND(F.lit(1 << (i % MASK_BITS)).cast("bigint")) != 0)


def _dedupe_counts_rows(spec: JobSpec, df: DataFrame) -> bool:
    d = spec.dedupe
    if d is None or d.strategy in ("any", "window"):
        return False
    return aggregatable(df, d.order_by)


@dataclass
class PlannedJob:
    """A batch job compiled to the exact DataFrame that will be written.

    ``frame.explain()`` shows the physical plan of the write; nothing has run.
    """

    spec: JobSpec
    run_date: dt.date
    run_ts: dt.datetime
    frame: DataFrame
    observation: Observation
    metrics: MetricPlan | None
    metrics_input: DataFrame | None
    converted: list[str]
    dup_from_dedupe: bool
    separate_dups: DataFrame | None
    states: MetricPlan | None = None
    unique: IndexStep | None = None
    rows_before: Callable[[], int] | None = None  # where the observation cannot know them
    quarantine: Quarantine | None = None

    def release(self) -> None:
        """Free what the plan keeps on disk between its writes."""
        if self.quarantine is not None:
            self.quarantine.release()

    def result(self, spark: SparkSession) -> JobResult:
        """Report from the observation; call after ``frame`` was written."""
        values = self.observation.get
        if self.rows_before is not None:
            values = {**values, "__rows_before": self.rows_before()}
        rows_written = int(values["__rows_after"])
        q = self.spec.quality
        report = None
        if q is not None:
            self.metrics.bind_schema(self.metrics_input)
            report = self.metrics.from_row(spark, values)
        if q is not None:
            if self.dup_from_dedupe:
                one = spark.createDataFrame(
                    [(int(values["__rows_before"]), rows_written)],
                    "__total bigint, __unique bigint",
                )
                report = report.unionByName(
                    report_from_parts(None, duplicates_shape(one, q.keys), None, None)
                )
            elif self.separate_dups is not None:
                # evaluated now (one row), so the report outlives the input files
                dups = self.separate_dups
                one = spark.createDataFrame(dups.collect(), dups.schema)
                report = report.unionByName(report_from_parts(None, one, None, None))
            if self.converted:
                nulled = spark.createDataFrame(
                    [("conversion", c, "n_nulled", float(values[f"__nulled_{i}"]))
                     for i, c in enumerate(self.converted)],
                    "check string, subject string, metric string, value double",
                )
                report = report.unionByName(nulled)
        state = None
        if self.states is not None:
            self.states.bind_schema(self.metrics_input.withColumn(ROWS_COL, F.lit(1)))
            state = self.states.from_row(spark, values)
        rejected = None
        if self.quarantine is not None:
            rejected = self.quarantine.counts()
            if report is not None:
                report = report.unionByName(self.quarantine.report(spark, rejected))
        return JobResult(self.spec.sink.path, self.run_date, self.run_ts, rows_written, report, rejected, state)


def plan_job(
    spark: SparkSession,
    spec: JobSpec,
    run_date: dt.date | None = None,
    run_ts: dt.datetime | None = None,
    rows: DataFrame | None = None,
    unique: IndexStep | None = None,
) -> PlannedJob:
    """Compile a batch spec into the observed frame to write (lazy, no job).
    ``rows`` stand in for the spec's source (a micro-batch of an incremental job);
    ``unique`` keeps those of the de-duplicated rows that no earlier batch had."""
    if spec.ingest is not None and rows is None:
        raise SpecError("plan_job compiles batch jobs; this spec is incremental")
    if run_date is None or run_ts is None:
        run_date, run_ts = run_clock(run_ts)
    q = spec.quality
    held = spec.quarantine
    source = quarantined_source(spec.source, held)
    src = read_source(spark, source) if rows is None else rows
    if held is not None:
        src = keep_source(src, source)
    converted: list[str] = []
    if q is not None or (held is not None and held.conversions):
        names = converted_columns(spec)
        df = transform_frame(_keep_raw(src, names), spec, run_date, names)
        own = dict.fromkeys(own_name(df, c) for c in names)
        converted = [c for c in own if c is not None and RAW_PREFIX + c in df.columns]
        # raw copies of columns that a split has consumed
        df = df.drop(*(c for c in df.columns if c.startswith(RAW_PREFIX)
                       and c.removeprefix(RAW_PREFIX) not in converted))
    else:
        df = transform_frame(src, spec, run_date)
    quarantine = None
    if held is not None:
        nulled = [(c, col(RAW_PREFIX + c).isNotNull() & col(c).isNull()) for c in converted] if held.conversions else []
        quarantine = Quarantine(judge(df, source, nulled), [c for c, _ in nulled])
        df = quarantine.accepted
        if q is None:
            df, converted = df.drop(*[RAW_PREFIX + c for c in converted]), []
    if converted:
        # masks go last: as dedupe tie-breakers they only decide between rows
        # that are equal in every output column
        df = _nulled_masks(df, converted)
    counted = _dedupe_counts_rows(spec, df)
    dup_from_dedupe = bool(q and q.keys and counted and set(q.keys) == set(spec.dedupe.keys))
    pre_dedupe = df
    if spec.dedupe:
        df = keep_one(
            df, spec.dedupe.keys, spec.dedupe.order_by,
            "aggregate" if counted else spec.dedupe.strategy,
            count_col=ROWS_COL if counted else None,
        )
    rows_before = None
    if unique is not None:
        df = unique(df)
        if q is not None and set(q.keys) == set(spec.dedupe.keys):
            dup_from_dedupe = True
            rows_before = (lambda: unique.total(ROWS_COL)) if counted else pre_dedupe.count
    df = _stamp(df, spec, run_date, run_ts)
    # layout first: the observation must sit after the last exchange
    stamps = set(stamp_columns(spec))
    constant = bool(spec.sink.partition_by) and set(spec.sink.partition_by) <= stamps
    laid = prepare_layout(df, spec.sink, constant_partitions=constant)

    internal = [c for c in laid.columns if c == ROWS_COL or c.startswith(MASK_PREFIX)]
    data_cols = [c for c in laid.columns if c not in internal]
    exprs: dict = {}
    metrics = metrics_input = states = None
    metric_cols = list(q.columns) if q is not None and q.columns is not None else data_cols
    require_columns(laid, metric_cols)
    # without a dedupe on the quality key: an estimate can ride on the write's
    # observation; an exact count needs its own (pre-aggregated) shuffle
    approx_in_obs = bool(q and q.keys and not dup_from_dedupe and q.approx_duplicates)
    separate_dups = (
        duplicate_metrics(pre_dedupe, q.keys, approx=q.approx_duplicates)
        if q and q.keys and not dup_from_dedupe and not approx_in_obs else None
    )
    if q is not None:
        metrics_input = laid.select(*[col(c) for c in data_cols])
        metrics = quality_plan(metrics_input, q.ranges, metric_cols, q.describe,
                               q.warn_pct, q.legacy_null_valid,
                               list(q.keys) if approx_in_obs else None)
        exprs.update(metrics.exprs)
        if q.state_sink is not None:
            states = state_plan(metrics_input, q.ranges, metric_cols, q.keys, q.describe,
                                "__rows_before" if dup_from_dedupe else None)
            states.exprs["__rows_before"] = F.coalesce(F.sum(ROWS_COL if counted else F.lit(1)), F.lit(0))
            exprs.update(states.exprs)
    exprs["__rows_after"] = F.count(F.lit(1))
    if counted:
        exprs["__rows_before"] = F.coalesce(F.sum(ROWS_COL), F.lit(0))
    for i, c in enumerate(converted):
        exprs[f"__nulled_{i}"] = _nulled_count(i)
    obs = Observation(f"tidyframe_job_{uuid.uuid4().hex}")  # unique per run
    observed = laid.observe(obs, *[e.alias(n) for n, e in exprs.items()])
    frame = observed.drop(*internal) if internal else observed
    return PlannedJob(spec, run_date, run_ts, frame, obs, metrics, metrics_input,
                      converted, dup_from_dedupe, separate_dups, states, unique, rows_before, quarantine)


def run_job(
    spark: SparkSession,
    spec: JobSpec,
    run_date: dt.date | None = None,
    run_ts: dt.datetime | None = None,
    run_id: str | None = None,
) -> JobResult:
    """Run the job (one write); incremental when the spec has ``ingest``.  ``run_id`` names
    the run of an idempotent append (the run timestamp by default): a repeated id
    replaces what the run appended before."""
    if run_date is None or run_ts is None:
        run_date, run_ts = run_clock(run_ts)
    if spec.ingest is not None:
        from tidyframe.streaming.ingest import run_incremental

        return run_incremental(spark, spec, run_date, run_ts)
    planned = plan_job(spark, spec, run_date, run_ts)
    try:
        write_quarantine(planned)
        if spec.sink.idempotent:
            append_run(planned.frame, spec.sink, run_id or f"{run_ts:%Y%m%dT%H%M%S.%f}", layout=False)
        else:
            write_sink(planned.frame, spec.sink, layout=False, stamps=stamp_columns(spec))
        result = planned.result(spark)
    finally:
        planned.release()
    return keep_report(result, spec)


def write_quarantine(planned: PlannedJob, batch: str | None = None) -> None:
    """Write the rejected rows, if the job keeps any, with the run's date and timestamp."""
    if planned.quarantine is None:
        return
    sink = planned.spec.quarantine.sink
    if batch is not None:
        sink = _batch_folder(sink, batch)
    rows = add_run_stamps(planned.quarantine.rejected, planned.run_date, planned.run_ts, "run_date", "run_ts")
    if sink.format == "csv":  # holds no arrays
        rows = rows.withColumn("reasons", F.array_join("reasons", "; "))
    # the observed rows must be written as they are: no layout shuffle behind the observation
    write_sink(rows, sink, layout=False, stamps=() if batch else ("run_date", "run_ts"))


def _batch_folder(sink, batch: str):
    """A micro-batch writes a folder of its own, which a retry replaces."""
    return replace(sink, mode="overwrite", dynamic_overwrite=False,
                   path=f"{sink.path.rstrip('/')}/ingest_batch={batch}")


def keep_report(result: JobResult, spec: JobSpec, batch: str | None = None) -> JobResult:
    """Write the (small) report to ``quality.report_sink``, and the metric state to
    ``quality.state_sink``, with the run's date and timestamp, e.g. partitioned by
    ``run_date`` for a history that reruns replace day by day.

    ``batch`` names a micro-batch of an incremental job: its rows go to a folder
    ``ingest_batch=<batch>`` of their own, as the batch's data do, so that other batches
    of the day stay and a retry replaces what its first attempt wrote."""
    q = spec.quality
    if q is None:
        return result
    for rows, sink in ((result.report, q.report_sink), (result.state, q.state_sink)):
        if sink is None or rows is None:
            continue
        if batch is not None:
            sink = _batch_folder(sink, batch)
        stamped = add_run_stamps(rows, result.run_date, result.run_ts, "run_date", "run_ts")
        write_sink(stamped, sink, stamps=() if batch else ("run_date", "run_ts"))
    return result
