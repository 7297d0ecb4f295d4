"""Registered queries: one per operator family, each paired with an
independent DuckDB SQL oracle over the same parquet tables.

Every query reads whole tables (no id subsets, no row caps).  The test tables
contain no NULL, NaN or malformed text, so queries that exercise those paths
*inject* them with a deterministic rule over the whole table (e.g. every 7th
order gets an unparsable price); the oracle applies the same rule.

Queries that write (round trips, layouts, modes, ingest, job) put their files
under the shared ``spark.checkpoint.dir`` in a fresh folder per call.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.errors import SparkRuntimeException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidyframe.functions.casting import cast_columns, safe_cast
from tidyframe.functions.dates import age_years, reformat_date
from tidyframe.functions.frame import add_years, normalize_columns, reformat_dates
from tidyframe.functions.split import split_column
from tidyframe.functions.stamps import add_run_stamps
from tidyframe.functions.text import normalize_text, strip_accents, title_case, title_case_plain
from tidyframe.operators.columns import select_columns
from tidyframe.operators.dedupe import dedupe_report, keep_one
from tidyframe.operators.metric_state import report_from_state
from tidyframe.operators.quality import (
    completeness,
    describe_numeric,
    duplicate_metrics,
    quality_report,
    range_check,
)
from tidyframe.plans.job import run_job
from tidyframe.plans.spec import CastStep, JobSpec
from tidyframe.session import scratch_path
from tidyframe.sinks.runs import append_run, read_runs
from tidyframe.sinks.write import SinkSpec, write_sink
from tidyframe.sources.read import read_source
from tidyframe.sources.spec import SourceSpec
from tidyframe.streaming.ingest import ingest_files

QueryFn = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2026, 12, 1)
RUN_TS = dt.datetime(2026, 12, 1, 6, 30, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


# ------------------------------------------------------------------ injections


def events_with_gaps(spark: SparkSession, sf_dir: str, nan: bool = True) -> DataFrame:
    """events with NULLs (and NaN) injected by a fixed rule over all rows."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    value = F.when(eid % 13 == 0, F.lit(None).cast("double"))
    if nan:
        value = value.when(eid % 7 == 0, F.lit(float("nan")))
    return e.select(
        "event_id",
        "ts",
        F.when(eid % 10 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"),
        F.when(eid % 25 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("event_type"),
        value.otherwise(F.col("value")).alias("value"),
        F.when(eid % 3 == 0, F.lit(None)).otherwise(F.col("props")).alias("props"),
    )


EVENTS_WITH_GAPS_SQL = """
select event_id, ts,
  case when event_id % 10 = 0 then null else user_id end as user_id,
  case when event_id % 25 = 0 then null else event_type end as event_type,
  case when event_id % 13 = 0 then null
       when event_id % 7 = 0 then 'NaN'::double else value end as value,
  case when event_id % 3 = 0 then null else props end as props
from events"""

EVENTS_WITH_NULLS_SQL = """
select event_id, ts,
  case when event_id % 10 = 0 then null else user_id end as user_id,
  case when event_id % 25 = 0 then null else event_type end as event_type,
  case when event_id % 13 = 0 then null else value end as value,
  case when event_id % 3 = 0 then null else props end as props
from events"""


# --------------------------------------------------------------------- sources


def q_scan_parquet(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return select_columns(li, ["l_orderkey", "l_linenumber", "l_quantity",
                               "l_extendedprice", "l_shipdate"])


def _roundtrip(spark, sf_dir, fmt: str, options: dict) -> DataFrame:
    part = table(spark, sf_dir, "part")
    path = scratch_path(spark, f"roundtrip-{fmt}")
    write_sink(part, SinkSpec(path=path, format=fmt, mode="overwrite", options=options))
    return read_source(spark, SourceSpec(format=fmt, path=path, options=options,
                                         schema=_ddl(part)))


def q_roundtrip_csv(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "csv", {"header": True, "encoding": "utf-8"})


def q_roundtrip_json(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "json", {"encoding": "utf-8"})


def q_roundtrip_xml(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "xml", {"rowTag": "part"})


def q_roundtrip_parquet(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "parquet", {})


def _roundtrip_text(spark, sf_dir, fmt: str, options: dict) -> DataFrame:
    """Whole documents through a text format (quotes, markup, newlines)."""
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, f"roundtrip-{fmt}-text")
    write_sink(docs, SinkSpec(path=path, format=fmt, options=options))
    return read_source(spark, SourceSpec(format=fmt, path=path, options=options,
                                         schema=_ddl(docs)))


def q_roundtrip_csv_text(spark, sf_dir):
    return _roundtrip_text(spark, sf_dir, "csv",
                           {"header": True, "multiLine": True, "escape": '"'})


def q_roundtrip_json_text(spark, sf_dir):
    return _roundtrip_text(spark, sf_dir, "json", {})


def q_roundtrip_xml_text(spark, sf_dir):
    return _roundtrip_text(spark, sf_dir, "xml", {"rowTag": "doc"})


def _land_copies(spark, sf_dir) -> tuple[str, DataFrame]:
    """part landed twice as CSV batches (same rows, two arrival folders)."""
    part = table(spark, sf_dir, "part")
    root = scratch_path(spark, "glob")
    for day in ("20240101", "20240102"):
        write_sink(part, SinkSpec(path=f"{root}/part_{day}.csv", format="csv",
                                  options={"header": True}))
    return root, part


def q_scan_glob(spark, sf_dir):
    root, part = _land_copies(spark, sf_dir)
    df = read_source(spark, SourceSpec(format="csv", path=f"{root}/part_*.csv",
                                       options={"header": True}, schema=_ddl(part),
                                       file_path_col="source_file"))
    return df.withColumn(
        "batch", F.regexp_extract("source_file", r"part_(\d{8})\.csv", 1)
    ).drop("source_file")


def q_glob_dedupe(spark, sf_dir):
    """Glob over duplicated batches, then one row per key (200 -> 100 style)."""
    root, part = _land_copies(spark, sf_dir)
    df = read_source(spark, SourceSpec(format="csv", path=f"{root}/part_*.csv",
                                       options={"header": True}, schema=_ddl(part)))
    return keep_one(df, ["p_partkey"])


# ------------------------------------------------------------------ conversion


def q_cast_safe(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    messy = o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("abc"))
        .otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("12x"))
        .otherwise(F.col("o_custkey").cast("string")).alias("custkey"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(""))
        .otherwise(F.col("o_totalprice").cast("string")).alias("price2"),
    )
    out = cast_columns(messy, ["price", "price2", "not_there"], "double")
    return out.withColumn("custkey", safe_cast("custkey", "bigint"))


def q_text_normalize(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", normalize_text("text").alias("text_norm"))


def q_text_normalize_messy(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    messy = F.concat(F.lit("  "), F.col("p_name"), F.lit("\t\n  "), F.col("p_type"),
                     F.lit("\u00a0 "), F.upper(F.col("p_brand")), F.lit(" "))
    return p.select("p_partkey", normalize_text(messy).alias("text_norm"))


def q_text_title(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    messy = F.concat(F.lit(" "), F.upper(F.col("p_name")), F.lit("  "), F.col("p_type"))
    return p.select("p_partkey", title_case(messy).alias("name_title"))


def q_text_title_documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", title_case("text").alias("text_title"))


def q_text_title_plain(spark, sf_dir):
    """Names-style cleaning over whole documents: squish, title case, no accents."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", title_case_plain("text").alias("text_title"))


def q_text_unaccent(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", strip_accents("text").alias("text_plain"))


def q_date_reformat(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    text = (
        F.when(key % 11 == 0, F.lit("31/02/2000"))
        .when(key % 17 == 0, F.lit("2020-01-05"))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    )
    return o.select(
        "o_orderkey",
        reformat_date(text, "dd/MM/yyyy", "yyyy-MM-dd").alias("order_date"),
    )


def q_split_columns(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    code = (
        F.when(F.col("p_partkey") % 5 == 0, F.col("p_size").cast("string"))
        .when(F.col("p_partkey") % 7 == 0, F.concat(F.col("p_size").cast("string"), F.lit("/")))
        .otherwise(F.concat_ws("/", F.col("p_size").cast("string"), F.col("p_brand")))
    )
    df = p.select("p_partkey", code.alias("code"))
    return split_column(df, "code", ["size_part", "brand_part"], "/")


def q_age_years(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", age_years("o_orderdate", AS_OF).alias("age_years"))


def q_age_days365(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey",
                    age_years("o_orderdate", AS_OF, method="days365").alias("age_years"))


def q_age_years_messy(spark, sf_dir):
    """Birth dates with NULLs, text that is no date, days that do not exist, leap days."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")

    def born(bad_day: str, leap_day: str, fmt: str):
        return (F.when(key % 17 == 0, F.lit(None)).when(key % 11 == 0, F.lit("abc"))
                .when(key % 13 == 0, F.lit(bad_day)).when(key % 7 == 0, F.lit(leap_day))
                .otherwise(F.date_format("o_orderdate", fmt)))

    day_first = born("31/02/2000", "29/02/1996", "dd/MM/yyyy")
    return o.select(
        "o_orderkey",
        age_years(day_first, AS_OF, "dd/MM/yyyy").alias("age_pattern"),
        age_years(born("2000-02-31", "1996-02-29", "yyyy-MM-dd"), AS_OF).alias("age_iso"))


def q_run_stamp(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return add_run_stamps(o, AS_OF, RUN_TS, "processing_date", "processing_ts",
                          ts_type="timestamp_ntz")


# --------------------------------------------------------------- dedupe / quality


def q_dedupe_latest(spark, sf_dir):
    return keep_one(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate desc"])


def q_dedupe_latest_counted(spark, sf_dir):
    return keep_one(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate desc"],
                    count_col="n_orders")


def q_dedupe_mixed_text_order(spark, sf_dir):
    """A customer's latest order; of one day's orders the first by priority, then by the longest
    clerk-like text: text sorted against the date, with counts, in one shuffle."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.trunc("o_orderdate", "year").alias("year"), "o_orderstatus",
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None))
        .otherwise(F.substring("o_orderpriority", 1, 1 + F.col("o_orderkey") % 9)).alias("priority"))
    return keep_one(o, ["o_custkey"], ["year desc", "priority asc nulls last", "o_orderstatus"],
                    strategy="aggregate", count_col="n_orders")


def q_dedupe_documents(spark, sf_dir):
    """One document per normalised text (whitespace/case variants collapse)."""
    d = table(spark, sf_dir, "documents")
    normed = d.select("doc_id", normalize_text("text").alias("text_norm"), "lang", "source")
    return keep_one(normed, ["text_norm"], ["doc_id"])


def q_dedupe_report(spark, sf_dir):
    return dedupe_report(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_completeness(spark, sf_dir):
    return completeness(events_with_gaps(spark, sf_dir))


def q_duplicate_metrics(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    keyed = o.select(
        F.when(F.col("o_orderkey") % 50 == 0, F.lit(None))
        .otherwise(F.col("o_custkey")).alias("o_custkey")
    )
    return duplicate_metrics(keyed, ["o_custkey"])


def q_describe_numeric(spark, sf_dir):
    d = describe_numeric(table(spark, sf_dir, "lineitem"))
    # float sums depend on summation order; compare at 4 decimals
    return d.select("column", "count", F.round("mean", 4).alias("mean"),
                    F.round("stddev", 4).alias("stddev"), "min", "max")


RANGE_RULES = [
    {"column": "value", "min": 1.0, "max": 400.0},
    {"column": "user_id", "min": 10.0, "max": 90.0},
    {"column": "event_id", "min": 0.0, "max": 1e12},
]


def q_range_check(spark, sf_dir):
    return range_check(events_with_gaps(spark, sf_dir), RANGE_RULES)


def q_quality_report(spark, sf_dir):
    df = events_with_gaps(spark, sf_dir, nan=False)
    rep = quality_report(df, keys=["user_id"], rules=RANGE_RULES)
    return rep.withColumn("value", F.round("value", 4))


def q_quality_report_long(spark, sf_dir):
    """The same report through the wide-table (long) layout."""
    df = events_with_gaps(spark, sf_dir, nan=False)
    rep = quality_report(df, keys=["user_id"], rules=RANGE_RULES, layout="long")
    return rep.withColumn("value", F.round("value", 4))


def q_describe_numeric_long(spark, sf_dir):
    d = describe_numeric(table(spark, sf_dir, "lineitem"), layout="long")
    return d.select("column", "count", F.round("mean", 4).alias("mean"),
                    F.round("stddev", 4).alias("stddev"), "min", "max")


def q_clean_dedupe_profile(spark, sf_dir):
    """Flagship: scan -> normalise -> safe cast -> keep latest -> completeness."""
    o = table(spark, sf_dir, "orders")
    prepared = o.select(
        "o_orderkey",
        "o_custkey",
        normalize_text(F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit("  ")))
        .alias("priority"),
        safe_cast(
            F.when(F.col("o_orderkey") % 9 == 0, F.lit("n/a"))
            .otherwise(F.col("o_totalprice").cast("string")), "double"
        ).alias("total"),
        "o_orderdate",
    )
    latest = keep_one(prepared, ["o_custkey"], ["o_orderdate desc"])
    return completeness(latest)


# ----------------------------------------------------------------------- sinks


def q_write_partitioned(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "partitioned")
    write_sink(o, SinkSpec(path=path, partition_by=("o_orderstatus",)))
    return spark.read.schema(_ddl(o)).parquet(path)


def q_write_layout(spark, sf_dir):
    """One file for a bounded output (the table's completeness report: one
    row per column), four even files for the whole table."""
    p = table(spark, sf_dir, "part")
    out = None
    for label, frame, n in (("single", completeness(p), 1), ("four", p, 4)):
        path = scratch_path(spark, f"layout-{label}")
        write_sink(frame, SinkSpec(path=path, num_files=n))
        counted = spark.read.parquet(path).agg(
            F.count_distinct(F.col("_metadata.file_path")).alias("n_files"),
            F.count(F.lit(1)).alias("n_rows"),
        ).select(F.lit(label).alias("layout"), "n_files", "n_rows")
        out = counted if out is None else out.unionByName(counted)
    return out


def q_write_modes(spark, sf_dir):
    """Daily loads: dynamic overwrite per day (rerun-safe), then an append."""
    p = table(spark, sf_dir, "part")
    path = scratch_path(spark, "modes")

    def load(day: str, mode: str):
        df = p.withColumn("load_date", F.lit(dt.date.fromisoformat(day)))
        write_sink(df, SinkSpec(path=path, mode=mode, partition_by=("load_date",),
                                dynamic_overwrite=True))

    load("2024-01-01", "overwrite")
    load("2024-01-02", "overwrite")
    load("2024-01-02", "overwrite")  # rerun of day 2 replaces only day 2
    load("2024-01-03", "append")
    return spark.read.schema(_ddl(p) + ", load_date date").parquet(path)


def q_write_overwrite_static(spark, sf_dir):
    """A rewrite with fewer partition values leaves no stale partition behind."""
    o = table(spark, sf_dir, "orders")
    sink = SinkSpec(path=scratch_path(spark, "overwrite"), partition_by=("o_orderstatus",))
    write_sink(o, sink)
    write_sink(o.filter(F.col("o_orderstatus") != "F"), sink)
    return spark.read.schema(_ddl(o)).parquet(sink.path)


def q_write_target_size(spark, sf_dir):
    """Files by partition value for a target size: their number, and how many of them overlap
    the one before in the cluster column (none may).  Half of the orders get one status."""
    o = table(spark, sf_dir, "orders").withColumn(
        "status", F.when(F.col("o_orderkey") % 2 == 0, F.lit("hot")).otherwise(F.col("o_orderstatus")))
    sink = SinkSpec(path=scratch_path(spark, "target-size"), partition_by=("status",),
                    target_file_bytes=40_000, cluster_by="o_orderdate")
    write_sink(o, sink)
    back = spark.read.schema(_ddl(o)).parquet(sink.path)
    files = back.groupBy("status", F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"), F.min("o_orderdate").alias("low"), F.max("o_orderdate").alias("high"))
    before = Window.partitionBy("status").orderBy("low", "high")
    return files.withColumn("over", F.col("low") < F.lag("high").over(before)).groupBy("status").agg(
        F.count("*").alias("n_files"), F.sum("n").alias("n_rows"), F.count_if("over").alias("n_overlaps"))


def q_append_rerun_safe(spark, sf_dir):
    """Three runs append the orders: one is run twice, one fails half-way and is run again.
    Every order is there once."""
    o = table(spark, sf_dir, "orders")
    sink = SinkSpec(path=scratch_path(spark, "append-runs"), mode="append", idempotent=True)
    for day, rows in zip(("day1", "day2", "day3"), _three_drops(o), strict=True):
        if day == "day2":
            lost = F.raise_error(F.lit("lost half-way")).cast("double")
            try:
                append_run(rows.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 97 == 0, lost)
                                           .otherwise(F.col("o_totalprice"))), sink, day)
            except SparkRuntimeException:
                pass
            else:
                raise AssertionError("the broken attempt must fail")
        append_run(rows, sink, day)
        if day == "day1":
            append_run(rows, sink, day)
    return read_runs(spark, sink, _ddl(o))


# ---------------------------------------------------------------------- ingest


def q_ingest_incremental(spark, sf_dir):
    """Files arrive in two drops; the stream runs, reruns (no-op), runs again."""
    ev = table(spark, sf_dir, "events")
    root = scratch_path(spark, "ingest")
    landing, archive = f"{root}/landing", f"{root}/archive"
    src = SourceSpec(format="parquet", path=f"{landing}/*/*.parquet", schema=_ddl(ev))
    sink = SinkSpec(path=f"{root}/out", mode="append")
    cut = F.lit(dt.datetime(2024, 1, 16))
    for i, drop in enumerate((ev.filter(F.col("ts") < cut), ev.filter(F.col("ts") >= cut))):
        write_sink(drop, SinkSpec(path=f"{landing}/drop{i}", mode="overwrite"))
        ingest_files(spark, src, sink, f"{root}/checkpoint", archive)
        ingest_files(spark, src, sink, f"{root}/checkpoint", archive)  # rerun: nothing new
    return spark.read.schema(_ddl(ev)).parquet(f"{root}/out")


LATE = dt.datetime(1998, 4, 25)
LATEST = {"dedupe": {"keys": ["o_custkey"], "order_by": ["o_orderdate desc"]}}
ORDER_RULES = [{"column": "o_totalprice", "min": 1000.0, "max": 300000.0}]


def _ingest_drops(spark, rows: DataFrame, early, sink: dict, steps: dict | None = None):
    """``rows`` arrive in two drops, those of ``early`` first; after each the incremental
    job runs, and again with nothing new.  Returns the sink folder and the runs' results."""
    root = scratch_path(spark, "ingest-job")
    spec = JobSpec.from_dict({
        "source": {"format": "parquet", "path": f"{root}/landing/*/*.parquet", "schema": _ddl(rows)},
        "sink": {"path": f"{root}/out", "mode": "append", **sink},
        "stamps": None,
        "ingest": {"checkpoint": f"{root}/checkpoint"},
        **(steps or {}),
    })
    results = []
    for i, drop in enumerate((rows.filter(early), rows.filter(~early))):
        write_sink(drop, SinkSpec(path=f"{root}/landing/drop{i}", mode="overwrite"))
        results += [run_job(spark, spec, AS_OF, RUN_TS) for _ in range(2)]
    return spec.sink.path, results


def q_ingest_job_latest(spark, sf_dir):
    """Orders arrive in two drops; each run of the job keeps a customer's latest of its drop."""
    orders = table(spark, sf_dir, "orders")
    out, _ = _ingest_drops(spark, orders, F.col("o_orderdate") < LATE, {}, LATEST)
    return spark.read.parquet(out).drop("ingest_batch")


def q_ingest_job_report(spark, sf_dir):
    """The report of each drop's run, with a JSON sink: rows as written, duplicates before."""
    orders = table(spark, sf_dir, "orders")
    quality = {"keys": ["o_custkey"], "ranges": ORDER_RULES}
    _, results = _ingest_drops(spark, orders, F.col("o_orderdate") < LATE, {"format": "json"},
                               {**LATEST, "quality": quality})
    report = reduce(DataFrame.unionByName, [r.report for r in results])
    return report.withColumn("value", F.round("value", 4))


#: where the orders' three drops end
THREE_DROPS = (dt.datetime(1996, 1, 1), dt.datetime(1998, 4, 25))


def _three_drops(rows: DataFrame) -> list[DataFrame]:
    when, (a, b) = F.col("o_orderdate"), THREE_DROPS
    return [rows.filter(when < a), rows.filter((when >= a) & (when < b)), rows.filter(when >= b)]


def _drops_with_failure(spark, drops: list[DataFrame], steps: dict) -> tuple[str, list]:
    """Each drop lands and the incremental job runs, then runs again with nothing new.  In
    the second drop a first attempt fails in its batch (a cast that must not be)."""
    root = scratch_path(spark, "ingest-drops")
    steps = json.loads(json.dumps(steps).replace("ROOT", root))
    spec = JobSpec.from_dict({
        "source": {"format": "parquet", "path": f"{root}/landing/*/*.parquet", "schema": _ddl(drops[0])},
        "sink": {"path": f"{root}/out", "mode": "append"},
        "stamps": None, "ingest": {"checkpoint": f"{root}/checkpoint"}, **steps})
    text = next(f.name for f in drops[0].schema.fields if f.dataType.simpleString() == "string")
    broken = replace(spec, cast=(CastStep((text,), "double", "fail"),))
    results = []
    for i, drop in enumerate(drops):
        write_sink(drop, SinkSpec(path=f"{root}/landing/drop{i}", mode="overwrite"))
        if i == 1:
            try:
                run_job(spark, broken, AS_OF, RUN_TS)
            except StreamingQueryException:
                pass
            else:
                raise AssertionError("the broken attempt must fail")
        results += [run_job(spark, spec, AS_OF, RUN_TS) for _ in range(2)]
    return root, results


def q_ingest_report_history(spark, sf_dir):
    """Reports kept by an incremental job: three drops on one date, idle reruns and a retried
    batch leave every batch's report once."""
    drops = _three_drops(table(spark, sf_dir, "orders"))
    root, _ = _drops_with_failure(spark, drops, {**LATEST, "quality": {
        "keys": ["o_custkey"], "ranges": ORDER_RULES,
        "report_sink": {"path": "ROOT/reports", "partition_by": ["run_date"]}}})
    kept = spark.read.parquet(f"{root}/reports")
    return kept.select("check", "subject", "metric", F.round("value", 4).alias("value"), "batch_id",
                       F.col("run_date").cast("date").alias("run_date"))


def q_ingest_unique_across_runs(spark, sf_dir):
    """Orders in three drops: a customer's latest order of the first drop that has the
    customer, whatever later drops bring, with a batch that fails and is retried."""
    drops = _three_drops(table(spark, sf_dir, "orders"))
    root, _ = _drops_with_failure(spark, drops, {**LATEST, "ingest": {
        "checkpoint": "ROOT/checkpoint", "unique_index": "ROOT/index", "unique_buckets": 16,
        "unique_bits": 1 << 14}})
    return spark.read.parquet(f"{root}/out").drop("ingest_batch")


def q_metrics_merged(spark, sf_dir):
    """Metric states of events that arrive in seven files, one batch each, merge into the
    report of the whole table."""
    g = events_with_gaps(spark, sf_dir, nan=False)
    root = scratch_path(spark, "metric-states")
    for k in range(7):
        write_sink(g.filter(F.pmod(F.xxhash64("event_id"), F.lit(7)) == k),
                   SinkSpec(path=f"{root}/landing/part{k}", num_files=1))
    run_job(spark, JobSpec.from_dict({
        "source": {"format": "parquet", "path": f"{root}/landing/*/*.parquet", "schema": _ddl(g)},
        "sink": {"path": f"{root}/out", "mode": "append"}, "stamps": None,
        "ingest": {"checkpoint": f"{root}/checkpoint", "max_files_per_batch": 1},
        "quality": {"keys": ["user_id"], "ranges": RANGE_RULES, "state_sink": {"path": f"{root}/states"}},
    }), AS_OF, RUN_TS)
    report = report_from_state(spark.read.parquet(f"{root}/states"))
    return report.withColumn("value", F.round("value", 4))


def q_ingest_watermark_report(spark, sf_dir):
    """Rows unique across runs within a watermark, into a JSON sink with a column that is all
    NULL: the report is of the rows as written, duplicates counted."""
    ev = table(spark, sf_dir, "events").withColumn("note", F.lit(None).cast("string"))
    root = scratch_path(spark, "watermark")
    spec = JobSpec.from_dict({
        "source": {"format": "parquet", "path": f"{root}/landing/*/*.parquet", "schema": _ddl(ev)},
        "sink": {"path": f"{root}/out", "format": "json", "mode": "append"},
        "dedupe": {"keys": ["event_id"]}, "stamps": None,
        "cast": [{"columns": ["ts"], "to": "timestamp"}],  # a watermark takes no other type
        "ingest": {"checkpoint": f"{root}/checkpoint", "watermark_column": "ts",
                   "watermark_delay": "400 days"},
        "quality": {"keys": ["event_id"], "ranges": RANGE_RULES, "state_sink": {"path": f"{root}/states"}}})
    for i in range(2):  # every event comes again in the second drop
        write_sink(ev, SinkSpec(path=f"{root}/landing/drop{i}"))
        run_job(spark, spec, AS_OF, RUN_TS)
        run_job(spark, spec, AS_OF, RUN_TS)
    report = report_from_state(spark.read.parquet(f"{root}/states"))
    return report.withColumn("value", F.round("value", 4))


def q_ingest_archived(spark, sf_dir):
    """Orders in three drops: after each run the files it read are in the archive, and
    only these.  The rows of all archived files, with the drop that brought them."""
    drops = _three_drops(table(spark, sf_dir, "orders"))
    root, _ = _drops_with_failure(spark, drops, {"ingest": {
        "checkpoint": "ROOT/checkpoint", "archive_dir": "ROOT/archive"}})
    rows = spark.read.schema(_ddl(drops[0])).option("recursiveFileLookup", "true").parquet(f"{root}/archive")
    return rows.withColumn("part", F.regexp_extract(F.col("_metadata.file_path"), "/landing/drop([0-9])/", 1).cast("int"))


def q_ingest_skips_identical_files(spark, sf_dir):
    """Orders arrive in three drops as CSV, each with the files of the drop before under other
    names: every order comes through once."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "ledger")
    options = {"header": True, "escape": '"'}
    spec = JobSpec.from_dict({
        "source": {"format": "csv", "path": f"{root}/landing/*/*.csv", "schema": _ddl(orders), "options": options},
        "sink": {"path": f"{root}/out", "mode": "append"}, "stamps": None,
        "ingest": {"checkpoint": f"{root}/checkpoint", "content_ledger": f"{root}/ledger"}})
    before = None
    for k, drop in enumerate(_three_drops(orders)):
        # a second write of these rows gives files of the same bytes
        rows = drop.repartition(4, "o_orderkey").sortWithinPartitions("o_orderkey")
        if before is not None:
            write_sink(before, SinkSpec(path=f"{root}/landing/again{k}", format="csv", options=options))
        write_sink(rows, SinkSpec(path=f"{root}/landing/drop{k}", format="csv", options=options))
        before = rows
        run_job(spark, spec, AS_OF, RUN_TS)
    return spark.read.schema(_ddl(orders)).parquet(f"{root}/out").drop("ingest_batch")


def q_ingest_csv_text(spark, sf_dir):
    """Whole documents with spaces around the text come through a CSV sink unchanged."""
    docs = table(spark, sf_dir, "documents").withColumn(
        "text", F.concat(F.lit("  "), "text", F.lit(" ")))
    options = {"header": True, "multiLine": True, "escape": '"'}
    out, _ = _ingest_drops(spark, docs, F.col("doc_id") % 2 == 0, {"format": "csv", "options": options})
    return read_source(spark, SourceSpec(format="csv", path=out, options=options,
                                         schema=_ddl(docs))).drop("ingest_batch")


def q_ingest_xml(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    options = {"rowTag": "part"}
    out, _ = _ingest_drops(spark, part, F.col("p_partkey") % 2 == 0, {"format": "xml", "options": options})
    return read_source(spark, SourceSpec(format="xml", path=out, options=options,
                                         schema=_ddl(part))).drop("ingest_batch")


def q_scan_glob_headers(spark, sf_dir):
    """Files of one glob with their columns in three orders, one of them without ``p_size``."""
    part = table(spark, sf_dir, "part")
    root = scratch_path(spark, "headers")
    orders = (part.columns, part.columns[::-1], sorted(set(part.columns) - {"p_size"}, key=lambda c: c[::-1]))
    options = {"header": True, "escape": '"'}
    for k, columns in enumerate(orders):
        rows = part.filter(F.pmod("p_partkey", F.lit(3)) == k).select(*columns)
        write_sink(rows, SinkSpec(path=f"{root}/drop_{k}", format="csv", options=options))
    return read_source(spark, SourceSpec(format="csv", path=f"{root}/drop_*/*.csv", options=options,
                                         schema=_ddl(part), headers="by_name"))


# ------------------------------------------------------------------------- job

JOB_INPUT_SCHEMA = (
    "order_id string, customer_id string, status_priority string, "
    "priority_note string, order_date string, total string"
)


def _job_input(spark, sf_dir) -> str:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    messy = o.select(
        key.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.concat_ws("/", "o_orderstatus", "o_orderpriority").alias("status_priority"),
        F.concat(F.lit("  "), F.upper("o_orderpriority"), F.lit(" \t ")).alias("priority_note"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("order_date"),
        F.when(key % 9 == 0, F.lit("n/a"))
        .otherwise(F.col("o_totalprice").cast("string")).alias("total"),
    )
    path = scratch_path(spark, "job-input")
    write_sink(messy, SinkSpec(path=path, format="csv", options={"header": True}))
    return path


def job_spec(src: str, out: str) -> JobSpec:
    return JobSpec.from_dict({
        "source": {"format": "csv", "path": src, "options": {"header": True},
                   "schema": JOB_INPUT_SCHEMA},
        "sink": {"path": out, "partition_by": ["processing_date"]},
        "dedupe": {"keys": ["customer_id"], "order_by": ["order_date desc"]},
        "clean": {
            "normalize_text": ["priority_note"],
            "reformat_date": [{"column": "order_date", "from": "dd/MM/yyyy"}],
            "split": [{"column": "status_priority", "into": ["status", "priority"]}],
        },
        "cast": [{"columns": ["order_id", "customer_id"], "to": "bigint"},
                 {"columns": ["total"], "to": "double"}],
        "years_between": [{"column": "order_age", "start": "order_date"}],
        "stamps": {"date_column": "processing_date", "ts_column": "processing_ts",
                   "ts_type": "timestamp_ntz"},
        "quality": {"keys": ["customer_id"],
                    "ranges": [{"column": "total", "min": 1000.0, "max": 500000.0}]},
    })


def run_prep_job(spark, sf_dir):
    src = _job_input(spark, sf_dir)
    out = scratch_path(spark, "job-output")
    result = run_job(spark, job_spec(src, out), AS_OF, RUN_TS)
    return out, result


def q_prep_job(spark, sf_dir):
    out, _ = run_prep_job(spark, sf_dir)
    return spark.read.parquet(out)


def q_prep_job_report(spark, sf_dir):
    _, result = run_prep_job(spark, sf_dir)
    return result.report.withColumn("value", F.round("value", 4))


def q_prep_job_conversions(spark, sf_dir):
    """Values that became NULL in a split's cast, in the cast of a split part and in a
    year difference, counted during the write."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    messy = o.select(
        key.cast("string").alias("order_id"),
        F.when(key % 5 == 0, F.lit("12/x")).when(key % 7 == 0, F.lit("y"))
        .otherwise(F.concat_ws("/", F.col("o_custkey").cast("string"), (key % 100).cast("string")))
        .alias("pair"),
        F.concat_ws("/", "o_orderstatus", F.when(key % 9 == 0, F.lit("none"))
                    .otherwise(F.col("o_totalprice").cast("string"))).alias("tagged"),
        F.when(key % 11 == 0, F.lit("abc")).when(key % 13 == 0, F.lit("31/02/2000"))
        .when(key % 17 == 0, F.lit(None)).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
        .alias("born"),
    )
    src = scratch_path(spark, "conversions-input")
    write_sink(messy, SinkSpec(path=src))
    result = run_job(spark, JobSpec.from_dict({
        "source": {"format": "parquet", "path": src, "schema": _ddl(messy)},
        "sink": {"path": scratch_path(spark, "conversions")},
        "clean": {"split": [{"column": "pair", "into": ["left", "right"], "cast": "int"},
                            {"column": "tagged", "into": ["status", "total"]}]},
        "cast": [{"columns": ["order_id"], "to": "bigint"}, {"columns": ["total"], "to": "double"}],
        "years_between": [{"column": "age", "start": "born", "pattern": "dd/MM/yyyy"}],
        "stamps": None,
        "quality": {"describe": False},
    }), AS_OF, RUN_TS)
    return result.report.filter("check = 'conversion'")


def q_prep_job_quarantine(spark, sf_dir):
    """Both sides of a job over text lines: every tenth order has a field too many, others an
    unreadable total or an impossible date."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    lines = o.select(F.concat_ws(
        ",", key.cast("string"), F.col("o_custkey").cast("string"),
        F.when(key % 11 == 0, F.lit("31/02/2000")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")),
        F.when(key % 9 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")),
        F.when(key % 10 == 3, F.lit("more"))).alias("value"))
    root = scratch_path(spark, "quarantine")
    lines.write.text(f"{root}/in")
    result = run_job(spark, JobSpec.from_dict({
        "source": {"format": "csv", "path": f"{root}/in",
                   "schema": "order_id string, customer_id string, order_date string, total string"},
        "sink": {"path": f"{root}/out"}, "stamps": None,
        "clean": {"reformat_date": [{"column": "order_date", "from": "dd/MM/yyyy"}]},
        "cast": [{"columns": ["order_id", "customer_id"], "to": "bigint"}, {"columns": ["total"]}],
        "dedupe": {"keys": ["customer_id"], "order_by": ["order_date desc"]},
        "quality": {}, "quarantine": {"sink": {"path": f"{root}/rejected"}},
    }), AS_OF, RUN_TS)
    accepted = spark.read.parquet(f"{root}/out").select(
        F.lit("accepted").alias("side"), "order_id", "customer_id", "order_date", "total",
        F.lit(None).cast("string").alias("record"), F.lit(None).cast("string").alias("reasons"))
    rejected = spark.read.parquet(f"{root}/rejected").select(
        F.lit("rejected").alias("side"), *(F.lit(None).cast(t).alias(c) for c, t in accepted.dtypes[1:5]),
        "record", F.array_join("reasons", "; ").alias("reasons"))
    counts = result.report.filter("check = 'quarantine'").select(
        F.lit("counted").alias("side"), *(F.lit(None).cast(t).alias(c) for c, t in accepted.dtypes[1:4]),
        F.col("value").alias("total"), F.col("metric").alias("record"), F.col("subject").alias("reasons"))
    return accepted.unionByName(rejected).unionByName(counts)


def q_chain_steps(spark, sf_dir):
    """The steps of ``prep_job`` chained over the frame, without a spec."""
    raw = read_source(spark, SourceSpec(format="csv", path=_job_input(spark, sf_dir),
                                        options={"header": True}, schema=JOB_INPUT_SCHEMA))
    return (raw.transform(normalize_columns, ["priority_note"])
            .transform(reformat_dates, "order_date", "dd/MM/yyyy")
            .transform(split_column, "status_priority", ["status", "priority"])
            .transform(cast_columns, ["order_id", "customer_id"], "bigint")
            .transform(cast_columns, ["total"])
            .transform(add_years, "order_age", "order_date", AS_OF)
            .transform(keep_one, ["customer_id"], ["order_date desc"])
            .transform(add_run_stamps, AS_OF, RUN_TS, "processing_date", "processing_ts",
                       ts_type="timestamp_ntz"))


# -------------------------------------------------------------------- registry


QUERIES: dict[str, QueryFn] = {
    "scan_parquet": q_scan_parquet,
    "roundtrip_csv": q_roundtrip_csv,
    "roundtrip_json": q_roundtrip_json,
    "roundtrip_xml": q_roundtrip_xml,
    "roundtrip_parquet": q_roundtrip_parquet,
    "roundtrip_csv_text": q_roundtrip_csv_text,
    "roundtrip_json_text": q_roundtrip_json_text,
    "roundtrip_xml_text": q_roundtrip_xml_text,
    "scan_glob": q_scan_glob,
    "glob_dedupe": q_glob_dedupe,
    "scan_glob_headers": q_scan_glob_headers,
    "cast_safe": q_cast_safe,
    "text_normalize": q_text_normalize,
    "text_normalize_messy": q_text_normalize_messy,
    "text_title": q_text_title,
    "text_title_documents": q_text_title_documents,
    "text_title_plain": q_text_title_plain,
    "text_unaccent": q_text_unaccent,
    "date_reformat": q_date_reformat,
    "split_columns": q_split_columns,
    "age_years": q_age_years,
    "age_days365": q_age_days365,
    "age_years_messy": q_age_years_messy,
    "run_stamp": q_run_stamp,
    "dedupe_latest": q_dedupe_latest,
    "dedupe_latest_counted": q_dedupe_latest_counted,
    "dedupe_mixed_text_order": q_dedupe_mixed_text_order,
    "dedupe_documents": q_dedupe_documents,
    "dedupe_report": q_dedupe_report,
    "completeness": q_completeness,
    "duplicate_metrics": q_duplicate_metrics,
    "describe_numeric": q_describe_numeric,
    "range_check": q_range_check,
    "quality_report": q_quality_report,
    "quality_report_long": q_quality_report_long,
    "describe_numeric_long": q_describe_numeric_long,
    "clean_dedupe_profile": q_clean_dedupe_profile,
    "write_partitioned": q_write_partitioned,
    "write_layout": q_write_layout,
    "write_modes": q_write_modes,
    "write_overwrite_static": q_write_overwrite_static,
    "write_target_size": q_write_target_size,
    "append_rerun_safe": q_append_rerun_safe,
    "ingest_incremental": q_ingest_incremental,
    "ingest_job_latest": q_ingest_job_latest,
    "ingest_job_report": q_ingest_job_report,
    "ingest_report_history": q_ingest_report_history,
    "ingest_unique_across_runs": q_ingest_unique_across_runs,
    "ingest_archived": q_ingest_archived,
    "ingest_skips_identical_files": q_ingest_skips_identical_files,
    "metrics_merged": q_metrics_merged,
    "ingest_watermark_report": q_ingest_watermark_report,
    "ingest_csv_text": q_ingest_csv_text,
    "ingest_xml": q_ingest_xml,
    "prep_job": q_prep_job,
    "prep_job_report": q_prep_job_report,
    "prep_job_conversions": q_prep_job_conversions,
    "prep_job_quarantine": q_prep_job_quarantine,
    "chain_steps": q_chain_steps,
}
