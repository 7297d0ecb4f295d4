"""What incremental jobs keep between runs: reports, metric states, the key index."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException

import tidyframe.plans.job as job_module
from tidyframe.errors import SpecError
from tidyframe.operators.metric_state import merge_states, metric_state, report_from_state
from tidyframe.operators.quality import quality_report
from tidyframe.plans import JobSpec, run_job
from tidyframe.sinks.write import SinkSpec, write_sink
from tidyframe.streaming.key_index import KeyIndex, unique_across_batches

DAY, NOW = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 6)
DDL = "id string, seen int, v double"


def land(spark, scratch, name, rows, ddl=DDL):
    write_sink(spark.createDataFrame(rows, ddl), SinkSpec(path=f"{scratch}/landing/{name}", num_files=1))


def spec_of(scratch, **more):
    return JobSpec.from_dict({
        "source": {"format": "parquet", "path": f"{scratch}/landing/*/*.parquet", "schema": DDL},
        "sink": {"path": f"{scratch}/out", "mode": "append"},
        "dedupe": {"keys": ["id"], "order_by": ["seen desc"]}, "stamps": None,
        **more, "ingest": {"checkpoint": f"{scratch}/checkpoint", **more.get("ingest", {})}})


def rows_of(spark, path):
    return sorted(((r["id"], r["seen"]) for r in spark.read.parquet(path).collect()), key=str)


# ------------------------------------------------------------------ kept reports


def test_kept_reports_survive_idle_runs_and_retries(spark, scratch, monkeypatch):
    quality = {"keys": ["id"], "report_sink": {"path": f"{scratch}/reports"},
               "state_sink": {"path": f"{scratch}/states"}}
    spec = spec_of(scratch, quality=quality)
    assert run_job_or_none(spark, spec) is None  # nothing has landed: no run, no report
    land(spark, scratch, "a", [("x", 1, 1.0), ("x", 2, 2.0), ("y", 1, None)])

    real = job_module.keep_report

    def keep_then_fail(*args):
        real(*args)
        raise RuntimeError("lost after the report was written")

    monkeypatch.setattr(job_module, "keep_report", keep_then_fail)
    with pytest.raises(StreamingQueryException):
        run_job(spark, spec, DAY, NOW)
    monkeypatch.setattr(job_module, "keep_report", real)
    run_job(spark, spec, DAY, NOW)
    assert run_job(spark, spec, DAY, NOW).report.count() == 0  # idle
    land(spark, scratch, "b", [("x", 3, 3.0)])
    run_job(spark, spec, DAY, NOW)

    total = spark.read.parquet(f"{scratch}/reports").filter("check = 'duplicates' and metric = 'total'")
    assert sorted((r["batch_id"], r["value"]) for r in total.collect()) == [(0, 3.0), (1, 1.0)]
    merged = {(r["check"], r["subject"], r["metric"]): r["value"]
              for r in report_from_state(spark.read.parquet(f"{scratch}/states")).collect()}
    # the batches wrote x, y and then x again: four rows came, two keys are distinct
    assert merged["duplicates", "id", "total"] == 4 and merged["duplicates", "id", "n_unique"] == 2
    assert merged["completeness", "v", "n_null"] == 1 and merged["describe", "v", "mean"] == 2.5


def run_job_or_none(spark, spec):
    report = run_job(spark, spec, DAY, NOW).report
    path = spec.quality.report_sink.path
    try:
        spark.read.parquet(path)
    except AnalysisException:
        assert report.count() == 0
        return None
    return report


def test_watermark_report_counts_duplicates_and_late_rows(spark, scratch):
    t = dt.datetime(2024, 1, 1, 10)
    ddl = "id string, ts timestamp, v double"
    spec = JobSpec.from_dict({
        "source": {"format": "parquet", "path": f"{scratch}/landing/*/*.parquet", "schema": ddl},
        "sink": {"path": f"{scratch}/out", "format": "json", "mode": "append"}, "dedupe": {"keys": ["id"]},
        "stamps": None, "quality": {"keys": ["id"]},
        "ingest": {"checkpoint": f"{scratch}/checkpoint", "watermark_column": "ts", "watermark_delay": "1 hour"}})
    hours = dt.timedelta(hours=1)
    land(spark, scratch, "a", [("a", t, None), ("a", t, None), ("b", t + 9 * hours, None)], ddl)
    values = lambda r: {(x["check"], x["subject"], x["metric"]): x["value"] for x in r.report.collect()}
    first = values(run_job(spark, spec, DAY, NOW))
    assert first["duplicates", "id", "n_duplicate"] == 1 and first["completeness", "v", "n_null"] == 2
    land(spark, scratch, "b", [("c", t, 1.0), ("b", t + 9 * hours, None), ("d", t + 9 * hours, 2.0)], ddl)
    result = run_job(spark, spec, DAY, NOW)
    second = values(result)
    assert second["watermark", "ts", "n_late"] == 1  # c came hours after the watermark
    assert second["duplicates", "id", "n_duplicate"] == 1 and result.rows_written == 1
    assert run_job(spark, spec, DAY, NOW).report.count() == 0


# ----------------------------------------------------------------- metric states


def test_merged_states_equal_one_report(spark):
    rng = random.Random(7)
    special = [None, float("nan"), 0.0, -0.0, 1e12, 1e12 + 1]
    rows = [(k, rng.choice(["a", "b", None]), rng.choice([*special, rng.random()]) if rng.random() < 0.3
             else 1e9 + rng.random(), rng.choice([None, rng.randint(-5, 5)])) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, t string, x double, `odd.name` int")
    rules = [{"column": "x", "min": 0, "max": 1e11}, {"column": "odd.name", "min": -1, "max": 1},
             {"column": "x", "min": -1, "max": 1}]
    for frame, parts in ((df.filter("x is null or not isnan(x)"), 9), (df, 3), (df.limit(0), 2), (df.limit(1), 2)):
        frame = frame.cache()
        states = None
        for k in range(parts):
            one = metric_state(frame.filter(f"id % {parts} = {k}"), ["t", "odd.name"], rules)
            states = one if states is None else states.unionByName(one)
        assert states.columns == metric_state(frame).columns
        twice = merge_states(merge_states(states))  # merging is idempotent
        want = quality_report(frame, ["t", "odd.name"], rules)
        key = lambda r: (r["check"], r["subject"], r["metric"])
        for s in (states, twice):
            got = report_from_state(s).collect()
            assert sorted(map(key, got)) == sorted(map(key, want.collect()))
            for a, b in zip(sorted(got, key=lambda r: (key(r), str(r["value"]))),
                            sorted(want.collect(), key=lambda r: (key(r), str(r["value"]))), strict=True):
                same = a["value"] == b["value"] or (
                    a["value"] is not None and b["value"] is not None and (
                        math.isclose(a["value"], b["value"], rel_tol=1e-9)
                        or math.isnan(a["value"]) and math.isnan(b["value"])))
                assert same, (a, b)


def test_states_by_day(spark):
    one = metric_state(spark.range(10).selectExpr("id", "cast(id as double) x"), ["id"])
    two = metric_state(spark.range(5, 12).selectExpr("id", "cast(id as double) x"), ["id"])
    states = one.selectExpr("'d1' day", "*").unionByName(two.selectExpr("'d2' day", "*"))
    pick = "metric = 'n_unique'"
    assert {r["day"]: r["value"] for r in report_from_state(states, ["day"]).filter(pick).collect()} == \
        {"d1": 10.0, "d2": 7.0}
    assert report_from_state(states).filter(pick).first()["value"] == 12.0
    with pytest.raises(SpecError):
        report_from_state(states.withColumnRenamed("day", "check"), ["check"])


def test_state_sink_must_hold_sketches():
    with pytest.raises(SpecError):
        JobSpec.from_dict({"source": {"format": "parquet", "path": "/x"}, "sink": {"path": "/y"},
                           "quality": {"state_sink": {"path": "/z", "format": "json"}}})


# --------------------------------------------------------------------- key index

SMALL = {"unique_buckets": 4, "unique_bits": 64}  # filters that fill up at once


def test_unique_across_runs_with_failures(spark, scratch, monkeypatch):
    spec = spec_of(scratch, quality={"keys": ["id"]},
                   ingest={"unique_index": f"{scratch}/index", "max_files_per_batch": 1, **SMALL})
    land(spark, scratch, "a", [(f"k{i}", 1, 0.0) for i in range(30)] + [("k1", 5, 0.0), (None, 1, 0.0)])
    assert run_job(spark, spec, DAY, NOW).rows_written == 31
    land(spark, scratch, "b", [(f"k{i}", 2, 0.0) for i in range(20, 40)] + [(None, 2, 0.0), ("k39", 9, 0.0)])

    # the second batch is lost after its rows, after its keys and after its filter
    real_write, real_commit = job_module.write_sink, None
    from pyspark.sql import DataFrameWriter

    from tidyframe.streaming import key_index

    real_commit, real_parquet = key_index.IndexStep.commit, DataFrameWriter.parquet
    fail = RuntimeError("lost")

    def no_commit(self):
        raise fail

    def keys_only(self, path, *args, **kw):
        if "/filter" in path:
            raise fail
        return real_parquet(self, path, *args, **kw)

    def after_commit(self):
        real_commit(self)
        raise fail

    for target, name, fake in ((key_index.IndexStep, "commit", no_commit), (DataFrameWriter, "parquet", keys_only),
                               (key_index.IndexStep, "commit", after_commit)):
        with monkeypatch.context() as m:
            m.setattr(target, name, fake)
            with pytest.raises(StreamingQueryException):
                run_job(spark, spec, DAY, NOW)
    assert job_module.write_sink is real_write
    result = run_job(spark, spec, DAY, NOW)
    assert result.rows_written == 10
    dups = {r["metric"]: r["value"] for r in result.report.filter("check = 'duplicates'").collect()}
    assert dups["total"] == 22 and dups["n_duplicate"] == 12  # copies of this and of earlier batches

    # another checkpoint over the same index sees every key
    other = spec_of(scratch, sink={"path": f"{scratch}/out2", "mode": "append"},
                    ingest={"checkpoint": f"{scratch}/checkpoint2", "unique_index": f"{scratch}/index", **SMALL})
    land(spark, scratch, "c", [("k3", 9, 0.0), ("new", 1, 0.0)])
    assert run_job(spark, other, DAY, NOW).rows_written == 1
    want = [("k1", 5)] + [(f"k{i}", 1) for i in range(30) if i != 1] + [("k39", 9)] + \
        [(f"k{i}", 2) for i in range(30, 39)] + [(None, 1)]
    assert rows_of(spark, f"{scratch}/out") == sorted(want, key=str)
    assert rows_of(spark, f"{scratch}/out2") == [("new", 1)]


def test_index_rebuilds_lost_filters_and_checks_settings(spark, scratch):
    out: dict[str, list] = {}

    def batch(name, keys, **settings):
        rows = spark.createDataFrame(keys, "a int, b string")
        settings = {"buckets": 8, "bits": 1 << 10, **settings}
        unique_across_batches(rows, f"{scratch}/ix", ["a", "b"], name,
                              lambda r: out.__setitem__(name, sorted(map(tuple, r.collect()), key=str)), **settings)

    batch("b0", [(1, "x"), (None, "x"), (1, None)])
    batch("b1", [(1, "x"), (2, "x"), (None, None)])
    for slot in range(2):  # both filters are lost
        spark.range(0).selectExpr("1 bucket", "array(1L) words", "1L seq", "'?' batch", "8 buckets", "1024 bits") \
            .write.mode("overwrite").parquet(f"{scratch}/ix/filter{slot}")
    batch("b2", [(2, "x"), (1, None), (3, "x")])
    batch("b2", [(2, "x"), (1, None), (3, "x")])  # the same batch again
    batch("b3", [(3, "x"), (4, "x")])
    assert out == {"b0": [(1, "x"), (1, None), (None, "x")], "b1": [(2, "x"), (None, None)],
                   "b2": [(3, "x")], "b3": [(4, "x")]}
    with pytest.raises(SpecError):
        batch("b4", [(5, "x")], bits=64)


def test_untouched_buckets_are_not_read(spark, scratch):
    index = KeyIndex(f"{scratch}/ix", ("id",), 64, 1 << 12)
    unique_across_batches(spark.range(300).coalesce(1), index.path, ["id"], "b0", lambda r: r.count(),
                          buckets=64, bits=1 << 12)
    step = index.step("b1")
    fresh = step(spark.createDataFrame([(7,), (1_000_000,)], "id bigint"))
    assert [r["id"] for r in fresh.collect()] == [1_000_000]
    plan = step.fresh._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and step.judged.filter("__index_maybe").count() < 2
    step.release()


def test_index_spec_rules():
    base = {"source": {"format": "parquet", "path": "/x"}, "sink": {"path": "/y", "mode": "append"}}
    with pytest.raises(SpecError):
        JobSpec.from_dict({**base, "ingest": {"checkpoint": "/c", "unique_index": "/i"}})
    with pytest.raises(SpecError):
        JobSpec.from_dict({**base, "dedupe": {"keys": ["id"]}, "ingest": {
            "checkpoint": "/c", "unique_index": "/i", "watermark_column": "t", "watermark_delay": "1 day"}})
    with pytest.raises(SpecError):
        KeyIndex("/i", ("id",), 4, 100)
