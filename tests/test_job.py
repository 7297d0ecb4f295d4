"""Job spec + runner end to end, legacy config layout, incremental ingest."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import count_jobs
from pyspark.sql import functions as F

from tidyframe.errors import SpecError
from tidyframe.plans import JobSpec, build_frame, from_legacy_attributes, run_job
from tidyframe.sinks import SinkSpec, write_sink
from tidyframe.sources import SourceSpec
from tidyframe.streaming import ingest_files

HEADER = ("PRONTUARIO NOME IDADE DATANASCIMENTO PRESSAOARTERIAL TEMPERATURA ALTURA PESO "
          "BATIMENTOSCARDIACOS SATURACAOOXIGENIO").split()
ROWS = [
    ("100001", "  Ana   Souza ", "40", "25/07/1936", "120/80", "36.5", "160.2", "60.1", "70", "98.0"),
    ("100002", "JOSÉ da Silva", "30", "31/02/2000", "130/90", "abc", "180.0", "85.0", "80", "97.5"),
    ("100003", "Zoë\tNandú", "12", "29/02/2012", "140", "43.0", "30.0", "40.0", "90", None),
    ("100004", "Maria", "59", "10/01/1964", "150/100", "36.0", "170.0", "70.0", "60", "99.0"),
]
VITALS_DDL = ", ".join(f"{c} string" for c in HEADER)


def land(spark, folder, name, rows=ROWS):
    df = spark.createDataFrame(rows, VITALS_DDL)
    write_sink(df, SinkSpec(path=f"{folder}/{name}", format="csv", options={"header": True}))


def legacy_attrs(src_glob, out, fmt="dd/MM/yyyy", move=False):
    """The older config layout, as its YAML would load (with a fixed date pattern)."""
    return {
        "destiny": {"file_path": out, "file_type": "json",
                    "options": {"encoding": "utf-8", "mode": "append", "sep": ""}},
        "enrichment": {"date_diff_years": [{"column": "IDADE_ATUAL",
                                            "start_date": "DATANASCIMENTO",
                                            "end_date": "2024-01-01"}]},
        "partitioning": {"num_particoes": None, "particionar_por": "DATA_PROCESSAMENTO"},
        "quality": {"coluna_chave": "PRONTUARIO", "validacoes_faixa": [
            {"coluna": "TEMPERATURA", "min": 35.0, "max": 42.0},
            {"coluna": "ALTURA", "min": 50.0, "max": 250.0},
            {"coluna": "PESO", "min": 20.0, "max": 300.0},
            {"coluna": "SATURACAOOXIGENIO", "min": 70.0, "max": 100.0}]},
        "source": {"file_path": src_glob, "file_type": "csv",
                   "options": {"delimiter": ",", "encoding": "utf-8", "header": "true"},
                   "schema": VITALS_DDL},
        "transformations": {"normalize_date": [{"column": "DATANASCIMENTO", "fmt": fmt}],
                            "normalize_text": ["NOME"],
                            "split_columns": [{"column": "PRESSAOARTERIAL",
                                               "new_columns": ["PRESSAO_SISTOLICA",
                                                               "PRESSAO_DIASTOLICA"],
                                               "pattern": "/"}]},
        "type_conversion": {"double_columns": ["TEMPERATURA", "ALTURA", "PESO",
                                               "SATURACAOOXIGENIO"]},
        "processing": {"remove_duplicates": True, "duplicate_key": "PRONTUARIO",
                       "move_processed_files": move, "processed_folder": out + "_archive"},
    }


RUN = (dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 8, 0, 0))


def test_legacy_minute_pattern_rejected(scratch):
    with pytest.raises(SpecError):
        from_legacy_attributes(legacy_attrs(scratch + "/*.csv", scratch + "/o", fmt="dd/mm/yyyy"))


def test_unknown_keys_raise(scratch):
    attrs = legacy_attrs(scratch + "/*.csv", scratch + "/o")
    with pytest.raises(SpecError):
        from_legacy_attributes({**attrs, "extra": {}})
    with pytest.raises(SpecError):
        JobSpec.from_dict({"source": {"format": "csv", "path": "/x"},
                           "sink": {"path": "/y"}, "clena": {}})
    with pytest.raises(SpecError):
        from_legacy_attributes(legacy_attrs(scratch + "/*.csv", scratch + "/o", move=True))


def test_legacy_job_end_to_end(spark, scratch):
    land(spark, scratch + "/raw", "vitals_20231024.csv")
    land(spark, scratch + "/raw", "vitals_20231024_011043.csv")  # byte-identical copy
    out = scratch + "/out"
    spec = from_legacy_attributes(legacy_attrs(scratch + "/raw/vitals_*.csv", out))
    assert spec.sink.mode == "append" and "sep" not in spec.sink.options
    res = run_job(spark, spec, *RUN)
    assert res.rows_written == 4

    df = spark.read.json(out)
    rows = {r["PRONTUARIO"]: r.asDict() for r in df.collect()}
    assert len(rows) == 4
    a, j, z, m = rows["100001"], rows["100002"], rows["100003"], rows["100004"]
    assert a["NOME"] == "ana souza" and j["NOME"] == "josé da silva" and z["NOME"] == "zoë nandú"
    assert a["DATANASCIMENTO"] == "1936-07-25" and j["DATANASCIMENTO"] is None
    assert (a["PRESSAO_SISTOLICA"], a["PRESSAO_DIASTOLICA"]) == ("120", "80")
    assert (z["PRESSAO_SISTOLICA"], z["PRESSAO_DIASTOLICA"]) == ("140", None)
    assert "PRESSAOARTERIAL" not in df.columns
    assert a["TEMPERATURA"] == 36.5 and j["TEMPERATURA"] is None
    assert m["IDADE_ATUAL"] == 59 and z["IDADE_ATUAL"] == 11 and j["IDADE_ATUAL"] is None
    assert {r["DATA_PROCESSAMENTO"] for r in rows.values()} == {dt.date(2024, 1, 1)}

    rep = {(r["check"], r["subject"], r["metric"]): r["value"] for r in res.report.collect()}
    assert rep[("duplicates", "PRONTUARIO", "total")] == 8.0
    assert rep[("duplicates", "PRONTUARIO", "n_unique")] == 4.0
    assert rep[("completeness", "TEMPERATURA", "n_null")] == 1.0
    assert rep[("completeness", "SATURACAOOXIGENIO", "n_null")] == 1.0
    assert rep[("range", "TEMPERATURA", "n_invalid")] == 1.0   # 43.0
    assert rep[("range", "TEMPERATURA", "n_null")] == 1.0      # 'abc'
    assert rep[("range", "ALTURA", "n_invalid")] == 1.0        # 30.0
    assert rep[("describe", "PESO", "max")] == 85.0


def test_job_runs_one_write_job_plus_metrics(spark, scratch):
    """Metrics ride on the write (Observation): no extra pass over the data."""
    land(spark, scratch + "/raw", "a.csv")
    spec = from_legacy_attributes(legacy_attrs(scratch + "/raw/*.csv", scratch + "/out"))
    plain = JobSpec(source=spec.source, sink=spec.sink, dedupe=spec.dedupe, clean=spec.clean,
                    cast=spec.cast, years_between=spec.years_between, stamps=spec.stamps)
    jobs_plain = count_jobs(spark, lambda: run_job(spark, plain, *RUN))
    jobs_quality = count_jobs(spark, lambda: run_job(spark, spec, *RUN))
    assert jobs_quality == jobs_plain


def test_rerun_same_day_is_idempotent(spark, scratch):
    land(spark, scratch + "/raw", "a.csv")
    attrs = legacy_attrs(scratch + "/raw/*.csv", scratch + "/out")
    attrs["destiny"] = {"file_path": scratch + "/out", "file_type": "parquet", "options": {}}
    spec = from_legacy_attributes(attrs)
    run_job(spark, spec, *RUN)
    run_job(spark, spec, *RUN)
    assert spark.read.parquet(scratch + "/out").count() == 4
    run_job(spark, spec, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2))
    days = spark.read.parquet(scratch + "/out").groupBy("DATA_PROCESSAMENTO").count().collect()
    assert sorted(r["count"] for r in days) == [4, 4]


def test_build_frame_is_lazy(spark, scratch):
    land(spark, scratch + "/raw", "a.csv")
    spec = from_legacy_attributes(legacy_attrs(scratch + "/raw/*.csv", scratch + "/out"))
    assert count_jobs(spark, lambda: build_frame(spark, spec, *RUN)) == 0


# ---------------------------------------------------------------------- ingest


def test_ingest_incremental_rerun_and_archive(spark, scratch):
    landing, out, ckpt, arch = (scratch + "/landing", scratch + "/out",
                                scratch + "/ckpt", scratch + "/archive")
    src = SourceSpec(format="csv", path=f"{landing}/*/*.csv", options={"header": True},
                     schema=VITALS_DDL)
    sink = SinkSpec(path=out, mode="append")
    land(spark, landing, "b1")
    ingest_files(spark, src, sink, ckpt, arch)
    assert spark.read.parquet(out).count() == 4
    ingest_files(spark, src, sink, ckpt, arch)  # nothing new
    assert spark.read.parquet(out).count() == 4
    land(spark, landing, "b2", ROWS[:2])
    ingest_files(spark, src, sink, ckpt, arch)
    assert spark.read.parquet(out).count() == 6
    # files of the first batch were archived once a later batch ran
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".csv")]
    assert archived


def test_ingest_dedupe_across_runs(spark, scratch):
    landing = scratch + "/landing"
    src = SourceSpec(format="csv", path=f"{landing}/*/*.csv", options={"header": True},
                     schema=VITALS_DDL)
    sink = SinkSpec(path=scratch + "/out", mode="append")
    land(spark, landing, "b1")
    ingest_files(spark, src, sink, scratch + "/ckpt", dedupe_keys=["PRONTUARIO"])
    land(spark, landing, "b2")  # same keys again
    ingest_files(spark, src, sink, scratch + "/ckpt", dedupe_keys=["PRONTUARIO"])
    assert spark.read.parquet(scratch + "/out").count() == 4


def test_job_incremental_mode(spark, scratch):
    landing = scratch + "/landing"
    land(spark, landing, "b1")
    attrs = legacy_attrs(f"{landing}/*/*.csv", scratch + "/out", move=True)
    attrs["destiny"] = {"file_path": scratch + "/out", "file_type": "parquet", "options": {}}
    spec = from_legacy_attributes(attrs, checkpoint=scratch + "/ckpt")
    # incremental dedupe keeps the first row seen per key
    res = run_job(spark, spec, *RUN)
    assert spark.read.parquet(scratch + "/out").count() == 4
    rep = {(r["check"], r["subject"], r["metric"]): r["value"] for r in res.report.collect()}
    assert rep[("completeness", "TEMPERATURA", "total")] == 4.0
    with pytest.raises(SpecError):
        ingest_files(spark, spec.source, SinkSpec(path=scratch + "/x"), scratch + "/c2")


def test_load_spec_yaml(spark, scratch):
    import yaml

    from tidyframe.plans import load_spec

    land(spark, scratch + "/raw", "a.csv")
    path = scratch + "/params.yml"
    with open(path, "w", encoding="utf-8") as fh:
        yaml.safe_dump({"attributes": legacy_attrs(scratch + "/raw/*.csv", scratch + "/out")}, fh)
    spec = load_spec(path)
    assert spec.dedupe.keys == ("PRONTUARIO",) and spec.sink.partition_by == ("DATA_PROCESSAMENTO",)
    assert run_job(spark, spec, *RUN).rows_written == 4
    with open(scratch + "/bad.yml", "w") as fh:
        fh.write("a: [1, 2\n")
    with pytest.raises(SpecError):
        load_spec(scratch + "/bad.yml")
    with pytest.raises(SpecError):
        load_spec(scratch + "/missing.yml")


def test_chaining_with_transform(spark):
    from tidyframe.functions import add_years, cast_columns, normalize_columns, reformat_dates
    from tidyframe.functions.split import split_pair
    from tidyframe.operators import keep_one

    df = spark.createDataFrame(ROWS, VITALS_DDL)
    out = (
        df.transform(normalize_columns, ["NOME"], "title_plain")
        .transform(reformat_dates, "DATANASCIMENTO", "dd/MM/yyyy")
        .transform(cast_columns, ["TEMPERATURA", "PESO"], "double")
        .transform(split_pair, "PRESSAOARTERIAL", "SYS", "DIA", "/", False, "int")
        .transform(add_years, "AGE", "DATANASCIMENTO", "2024-01-01", "yyyy-MM-dd")
        .transform(keep_one, ["PRONTUARIO"])
    )
    got = {r["PRONTUARIO"]: r for r in out.collect()}
    assert got["100001"]["NOME"] == "Ana Souza" and got["100001"]["SYS"] == 120
    assert got["100003"]["NOME"] == "Zoe Nandu" and got["100003"]["DIA"] is None
    assert got["100004"]["AGE"] == 59


def test_observation_sits_in_result_stage(spark, scratch):
    """Metrics are collected above the last exchange (result stage), where
    Spark merges each partition's accumulator once even after task retries."""
    from conftest import plan_text

    from tidyframe.plans import plan_job

    land(spark, scratch + "/raw", "a.csv")
    spec = from_legacy_attributes(legacy_attrs(scratch + "/raw/*.csv", scratch + "/out"))
    planned = plan_job(spark, spec, *RUN)
    plan = plan_text(planned.frame, "simple")
    lines = plan.splitlines()
    observe_at = next(i for i, ln in enumerate(lines) if "CollectMetrics" in ln)
    first_exchange = next(i for i, ln in enumerate(lines) if "Exchange" in ln)
    assert observe_at < first_exchange  # printed top-down: above every exchange
    # partitioned by the run-date stamp (one value per run): no rebalance shuffle
    assert "REBALANCE" not in plan.upper()
    assert plan.count("Exchange") == 1  # only the dedupe's key shuffle


def test_ingest_dedupe_within_watermark(spark, scratch):
    """Bounded-state dedupe: copies arriving within the delay are dropped."""
    ddl = "id string, ts timestamp, v string"
    landing = scratch + "/landing"
    src = SourceSpec(format="json", path=f"{landing}/*/*.json", schema=ddl)
    sink = SinkSpec(path=scratch + "/out", format="json", mode="append")

    def drop(name, rows):
        write_sink(spark.createDataFrame(rows, ddl), SinkSpec(path=f"{landing}/{name}",
                                                              format="json"))

    t = dt.datetime(2024, 1, 1, 10)
    drop("b1", [("a", t, "1"), ("a", t, "1"), ("b", t, "2")])
    ingest_files(spark, src, sink, scratch + "/ckpt", dedupe_keys=["id"],
                 watermark=("ts", "1 hour"))
    drop("b2", [("a", t + dt.timedelta(minutes=5), "1")])  # late copy within the delay
    ingest_files(spark, src, sink, scratch + "/ckpt", dedupe_keys=["id"],
                 watermark=("ts", "1 hour"))
    got = sorted(r["id"] for r in spark.read.json(scratch + "/out").collect())
    assert got == ["a", "b"]


def test_legacy_age_without_reformat_uses_day_first(spark, scratch):
    land(spark, scratch + "/raw", "a.csv")
    attrs = legacy_attrs(scratch + "/raw/*.csv", scratch + "/out")
    attrs["transformations"]["normalize_date"] = []
    spec = from_legacy_attributes(attrs)
    got = {r["PRONTUARIO"]: r["IDADE_ATUAL"] for r in build_frame(spark, spec, *RUN).collect()}
    assert got == {"100001": 87, "100002": None, "100003": 11, "100004": 59}


def test_cli_runs_yaml_spec(spark, scratch, capsys):
    import yaml

    from tidyframe.__main__ import main

    land(spark, scratch + "/raw", "a.csv")
    path = scratch + "/job.yml"
    with open(path, "w", encoding="utf-8") as fh:
        yaml.safe_dump({"attributes": legacy_attrs(scratch + "/raw/*.csv", scratch + "/out")}, fh)
    assert main([path, "--run-date", "2024-01-01"]) == 0
    out = capsys.readouterr().out
    assert "wrote 4 rows" in out and "completeness" in out
    assert main([path, "--explain"]) == 0
    with open(scratch + "/bad.yml", "w") as fh:
        fh.write("attributes: {source: {}}\n")
    assert main([scratch + "/bad.yml"]) == 2


def test_legacy_incremental_without_schema_uses_csv_header(spark, scratch):
    landing = scratch + "/landing"
    land(spark, landing, "b1")
    attrs = legacy_attrs(f"{landing}/*/*.csv", scratch + "/out", move=True)
    del attrs["source"]["schema"]
    attrs["destiny"] = {"file_path": scratch + "/out", "file_type": "parquet", "options": {}}
    spec = from_legacy_attributes(attrs, checkpoint=scratch + "/ckpt")
    run_job(spark, spec, *RUN)
    out = spark.read.parquet(scratch + "/out")
    assert out.count() == 4 and dict(out.dtypes)["TEMPERATURA"] == "double"
    land(spark, landing, "b2", ROWS[:1])  # a key of an earlier run is a new reading
    run_job(spark, spec, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2))
    assert spark.read.parquet(scratch + "/out").count() == 5
    bad = dict(attrs, source={**attrs["source"], "file_type": "json"})
    with pytest.raises(SpecError):
        from_legacy_attributes(bad, checkpoint=scratch + "/ckpt2")


def test_conversion_masks_beyond_62_columns(spark, scratch):
    n = 70
    cols = [f"c{k}" for k in range(n)]
    rows = [tuple("x" if k in (0, 61, 62, 69) else str(k) for k in range(n)),
            tuple(str(k) for k in range(n))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    write_sink(df, SinkSpec(path=scratch + "/in", format="csv", options={"header": True}))
    spec = JobSpec.from_dict({
        "source": {"format": "csv", "path": scratch + "/in", "options": {"header": True}},
        "sink": {"path": scratch + "/out"},
        "cast": [{"columns": cols, "to": "int"}],
        "stamps": None,
        "quality": {"describe": False},
    })
    res = run_job(spark, spec, *RUN)
    nulled = {r["subject"]: r["value"] for r in res.report.collect() if r["check"] == "conversion"}
    assert len(nulled) == n
    assert {c for c, v in nulled.items() if v == 1.0} == {"c0", "c61", "c62", "c69"}
    assert spark.read.parquet(scratch + "/out").columns == cols


def test_job_approx_duplicates_ride_on_the_write(spark, scratch):
    land(spark, scratch + "/raw", "a.csv")
    land(spark, scratch + "/raw", "b.csv")
    attrs = legacy_attrs(scratch + "/raw/*.csv", scratch + "/out")
    attrs["processing"]["remove_duplicates"] = False
    spec = from_legacy_attributes(attrs)
    approx = JobSpec(**{**spec.__dict__, "quality": type(spec.quality)(
        **{**spec.quality.__dict__, "approx_duplicates": True})})
    res = run_job(spark, approx, *RUN)
    rep = {(r["check"], r["metric"]): r["value"] for r in res.report.collect()}
    assert rep[("duplicates", "total")] == 8.0 and rep[("duplicates", "n_unique")] == 4.0


def test_job_on_empty_input(spark, scratch):
    land(spark, scratch + "/raw", "empty.csv", rows=[])
    attrs = legacy_attrs(scratch + "/raw/*.csv", scratch + "/out")
    attrs["destiny"] = {"file_path": scratch + "/out", "file_type": "parquet", "options": {}}
    res = run_job(spark, from_legacy_attributes(attrs), *RUN)
    assert res.rows_written == 0
    rep = {(r["check"], r["subject"], r["metric"]): r["value"] for r in res.report.collect()}
    assert rep[("completeness", "NOME", "pct_null")] == 0.0
    assert rep[("duplicates", "PRONTUARIO", "total")] == 0.0
    assert rep[("range", "PESO", "pct_valid")] == 0.0


def test_ingest_failed_batch_leaves_nothing_and_rerun_is_exactly_once(spark, scratch):
    from pyspark.sql import functions as F

    landing = scratch + "/landing"
    src = SourceSpec(format="csv", path=f"{landing}/*/*.csv", options={"header": True},
                     schema=VITALS_DDL)
    sink = SinkSpec(path=scratch + "/out", mode="append")

    def transform(fail: bool):
        def apply(df):
            poison = (F.col("PRONTUARIO") == F.lit("999999")) & F.lit(fail)
            return df.withColumn(
                "NOME", F.when(poison, F.raise_error(F.lit("poison row"))).otherwise(F.col("NOME")))
        return apply

    land(spark, landing, "b1")
    ingest_files(spark, src, sink, scratch + "/ckpt", transform=transform(True))
    assert spark.read.parquet(scratch + "/out").count() == 4
    land(spark, landing, "b2", [("999999",) + ROWS[0][1:], ("888888",) + ROWS[1][1:]])
    with pytest.raises(Exception):
        ingest_files(spark, src, sink, scratch + "/ckpt", transform=transform(True))
    assert spark.read.parquet(scratch + "/out").count() == 4  # no partial batch visible
    ingest_files(spark, src, sink, scratch + "/ckpt", transform=transform(False))
    ids = sorted(r["PRONTUARIO"] for r in spark.read.parquet(scratch + "/out").collect())
    assert ids == sorted([r[0] for r in ROWS] + ["999999", "888888"])


def test_failed_batch_job_leaves_output_untouched(spark, scratch):
    land(spark, scratch + "/raw", "a.csv")
    attrs = legacy_attrs(scratch + "/raw/*.csv", scratch + "/out")
    attrs["destiny"] = {"file_path": scratch + "/out", "file_type": "parquet", "options": {}}
    good = from_legacy_attributes(attrs)
    run_job(spark, good, *RUN)  # day 1
    strict = JobSpec(**{**good.__dict__, "cast": (type(good.cast[0])(
        good.cast[0].columns, "double", "fail"),)})
    day2 = (dt.date(2024, 1, 2), dt.datetime(2024, 1, 2))
    with pytest.raises(Exception):
        run_job(spark, strict, *day2)  # 'abc' temperature fails the job
    days = spark.read.parquet(scratch + "/out").groupBy("DATA_PROCESSAMENTO").count().collect()
    assert [(r["DATA_PROCESSAMENTO"], r["count"]) for r in days] == [(dt.date(2024, 1, 1), 4)]
    run_job(spark, good, *day2)
    assert spark.read.parquet(scratch + "/out").count() == 8


def test_metrics_exact_under_task_retries():
    """First attempts of half the tasks fail, in the map and the write stage:
    same rows, same counts in the report (tools/retry_check.py)."""
    import json
    import subprocess
    import sys

    from conftest import ROOT, SF_SMALL

    out = subprocess.run([sys.executable, f"{ROOT}/tools/retry_check.py", SF_SMALL],
                         capture_output=True, text=True, timeout=600, check=True).stdout
    res = json.loads(out.strip().splitlines()[-1])
    assert res["rows_written"][0] == res["rows_written"][1] > 0
    assert res["same_rows"] and res["same_keys"] and res["counts_exact"]
    assert res["float_max_rel_diff"] < 1e-12


def test_report_history_sink(spark, scratch):
    land(spark, scratch + "/raw", "a.csv")
    attrs = legacy_attrs(scratch + "/raw/*.csv", scratch + "/out")
    base = from_legacy_attributes(attrs)
    q = type(base.quality)(**{**base.quality.__dict__, "report_sink": SinkSpec(
        path=scratch + "/history", partition_by=("run_date",), num_files=1)})
    spec = JobSpec(**{**base.__dict__, "quality": q})
    run_job(spark, spec, *RUN)
    run_job(spark, spec, *RUN)  # rerun of the same day replaces its report
    run_job(spark, spec, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2))
    hist = spark.read.parquet(scratch + "/history")
    per_day = {r["run_date"]: r["count"] for r in hist.groupBy("run_date").count().collect()}
    assert len(per_day) == 2 and len(set(per_day.values())) == 1
    assert set(hist.columns) == {"check", "subject", "metric", "value", "run_ts", "run_date"}
    spec_dict = JobSpec.from_dict({
        "source": {"format": "csv", "path": "/x"}, "sink": {"path": "/y"},
        "quality": {"report_sink": {"path": "/h", "partition_by": ["run_date"]}}})
    assert spec_dict.quality.report_sink.partition_by == ("run_date",)


def test_typed_date_columns_skip_text_patterns(spark, scratch):
    from tidyframe.functions import add_years, reformat_dates

    df = spark.createDataFrame([(dt.date(1964, 1, 10),)], "birth date")
    assert df.transform(reformat_dates, "birth", "dd/MM/yyyy").first()[0] == "1964-01-10"
    assert df.transform(add_years, "age", "birth", "2024-01-01", "dd/MM/yyyy").first()["age"] == 59
    # the older layout's default day-first pattern does not break a typed column
    write_sink(df.withColumn("PRONTUARIO", F.lit("1")), SinkSpec(path=scratch + "/in"))
    base = {"source": {"format": "parquet", "path": scratch + "/in"},
            "sink": {"path": scratch + "/out"}}
    aged = JobSpec.from_dict({**base, "years_between": [
        {"column": "age", "start": "birth", "end": "2024-01-01", "pattern": "dd/MM/yyyy"}]})
    assert build_frame(spark, aged, *RUN).first()["age"] == 59
    text = JobSpec.from_dict({**base, "clean": {
        "reformat_date": [{"column": "birth", "from": "dd/MM/yyyy", "to": "dd.MM.yyyy"}]}})
    assert build_frame(spark, text, *RUN).first()["birth"] == "10.01.1964"



def test_wide_job_reports_the_rows_it_wrote(spark, scratch):
    """130 columns: the report rides on the write at every width, and equals a
    standalone report of the written rows."""
    from tidyframe.operators import quality_report as qr

    n = 130
    cols = [f"c{k}" for k in range(n)]
    rows = [tuple(str(r * k) if (r + k) % 7 else "x" for k in range(n)) for r in range(30)]
    src = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    write_sink(src, SinkSpec(path=scratch + "/in", format="csv", options={"header": True}))
    spec = JobSpec.from_dict({
        "source": {"format": "csv", "path": scratch + "/in", "options": {"header": True}},
        "sink": {"path": scratch + "/out", "partition_by": ["processing_date"]},
        "cast": [{"columns": cols, "to": "double"}],
        "quality": {"ranges": [{"column": "c1", "min": 0, "max": 50}]},
    })
    res = run_job(spark, spec, *RUN)
    got = {(r["check"], r["subject"], r["metric"]): r["value"] for r in res.report.collect()}
    written = spark.read.parquet(scratch + "/out")
    want = {(r["check"], r["subject"], r["metric"]): r["value"] for r in qr(
        written, rules=[{"column": "c1", "min": 0, "max": 50}], layout="wide").collect()}
    assert set(want) <= set(got)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-12, abs=1e-12) or (v != v and got[k] != got[k])
    assert got[("conversion", "c0", "n_nulled")] == sum(1 for r in rows if r[0] == "x")


def test_incremental_report_with_text_sink_and_microsecond_run_ts(spark, scratch):
    landing = scratch + "/landing"
    land(spark, landing, "b1")
    attrs = legacy_attrs(f"{landing}/*/*.csv", scratch + "/out", move=True)
    attrs["destiny"] = {"file_path": scratch + "/out", "file_type": "json", "options": {}}
    spec = from_legacy_attributes(attrs, checkpoint=scratch + "/ckpt")
    run_ts = dt.datetime(2024, 1, 1, 8, 0, 0, 123456)  # JSON keeps milliseconds only
    res = run_job(spark, spec, run_ts.date(), run_ts)
    rep = {(r["check"], r["subject"], r["metric"]): r["value"] for r in res.report.collect()}
    assert rep[("completeness", "NOME", "total")] == 4.0


def test_ignore_mode_second_run_writes_nothing(spark, scratch):
    land(spark, scratch + "/raw", "a.csv")
    spec = JobSpec.from_dict({
        "source": {"format": "csv", "path": scratch + "/raw/*.csv", "options": {"header": True}},
        "sink": {"path": scratch + "/out", "mode": "ignore"}, "quality": {},
    })
    assert run_job(spark, spec, *RUN).rows_written == 4
    assert run_job(spark, spec, *RUN).rows_written == 0  # target exists: Spark skips it
    assert spark.read.parquet(scratch + "/out").count() == 4
    bad = JobSpec.from_dict({
        "source": {"format": "csv", "path": scratch + "/raw/*.csv", "options": {"header": True}},
        "sink": {"path": scratch + "/out2"}, "quality": {"columns": ["nope"]},
    })
    from tidyframe.errors import MissingColumnError

    with pytest.raises(MissingColumnError):
        run_job(spark, bad, *RUN)


def test_archive_folder_with_glob_characters(spark, scratch):
    """The older config's processed folder is literally `.../processed/[project]`."""
    landing, arch = scratch + "/landing", scratch + "/processed/[project]"
    src = SourceSpec(format="csv", path=f"{landing}/*/*.csv", options={"header": True},
                     schema=VITALS_DDL)
    sink = SinkSpec(path=scratch + "/out", mode="append")
    land(spark, landing, "b1")
    ingest_files(spark, src, sink, scratch + "/ckpt", arch)
    land(spark, landing, "b2", ROWS[:1])
    ingest_files(spark, src, sink, scratch + "/ckpt", arch)
    assert spark.read.parquet(scratch + "/out").count() == 5
    archived = [f for _, _, fs in os.walk(scratch + "/processed") for f in fs if f.endswith(".csv")]
    assert archived


def test_incremental_job_counts_rows_written(spark, scratch):
    landing = scratch + "/landing"
    land(spark, landing, "b1")
    attrs = legacy_attrs(f"{landing}/*/*.csv", scratch + "/out", move=True)
    attrs["destiny"] = {"file_path": scratch + "/out", "file_type": "parquet", "options": {}}
    spec = from_legacy_attributes(attrs, checkpoint=scratch + "/ckpt")
    assert run_job(spark, spec, *RUN).rows_written == 4
    assert run_job(spark, spec, *RUN).rows_written == 0  # nothing new
    land(spark, landing, "b2", [ROWS[1], ROWS[1]])  # a key of the first run, twice in this one
    res = run_job(spark, spec, *RUN)  # the same stamps: the report still is of this run alone
    assert res.rows_written == 1
    rep = {(r["check"], r["subject"], r["metric"]): r["value"] for r in res.report.collect()}
    assert rep[("completeness", "NOME", "total")] == 1.0
    assert rep[("duplicates", "PRONTUARIO", "total")] == 2.0
    assert rep[("duplicates", "PRONTUARIO", "n_duplicate")] == 1.0


def test_incremental_retry_replaces_its_own_batch(spark, scratch, monkeypatch):
    from pyspark.errors import StreamingQueryException

    from tidyframe.plans.job import PlannedJob

    landing = scratch + "/landing"
    land(spark, landing, "b1")
    attrs = legacy_attrs(f"{landing}/*/*.csv", scratch + "/out", move=True)
    spec = from_legacy_attributes(attrs, checkpoint=scratch + "/ckpt")
    with monkeypatch.context() as m:  # the batch is written, its commit is not
        m.setattr(PlannedJob, "result", lambda self, spark: 1 / 0)
        with pytest.raises(StreamingQueryException):
            run_job(spark, spec, *RUN)
    res = run_job(spark, spec, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2))
    out = spark.read.json(scratch + "/out")
    assert res.rows_written == out.count() == 4
    assert {r[0] for r in out.select("DATA_PROCESSAMENTO").collect()} == {dt.date(2024, 1, 2)}


def test_job_with_a_report_runs_where_a_split_consumed_a_cast_column(spark, scratch):
    write_sink(spark.createDataFrame([("1/2", "3"), ("x/4", "y")], "ab string, c string"),
               SinkSpec(path=scratch + "/in"))
    spec = JobSpec.from_dict({
        "source": {"format": "parquet", "path": scratch + "/in"}, "sink": {"path": scratch + "/out"},
        "clean": {"split": [{"column": "ab", "into": ["a", "b"], "pattern": "/"}]},
        "cast": [{"columns": ["ab", "c"], "to": "int"}], "quality": {"keys": ["c"]},
    })
    rep = {(r["check"], r["subject"], r["metric"]): r["value"]
           for r in run_job(spark, spec, *RUN).report.collect()}
    assert rep[("conversion", "c", "n_nulled")] == 1.0 and ("conversion", "ab", "n_nulled") not in rep


def test_cli_incremental_older_layout(spark, scratch, capsys):
    import yaml

    from tidyframe.__main__ import main

    landing = scratch + "/landing"
    land(spark, landing, "b1")
    attrs = legacy_attrs(f"{landing}/*/*.csv", scratch + "/out", move=True)
    del attrs["source"]["schema"]  # as in a plain config: taken from the CSV header
    attrs["destiny"] = {"file_path": scratch + "/out", "file_type": "parquet", "options": {}}
    path = scratch + "/params.yml"
    with open(path, "w", encoding="utf-8") as fh:
        yaml.safe_dump({"attributes": attrs}, fh)
    assert main([path]) == 2  # incremental mode needs a checkpoint
    assert main([path, "--checkpoint", scratch + "/ckpt", "--run-date", "2024-01-01"]) == 0
    assert "wrote 4 rows" in capsys.readouterr().out
    assert main([path, "--checkpoint", scratch + "/ckpt", "--run-date", "2024-01-02"]) == 0
    assert "wrote 0 rows" in capsys.readouterr().out
    assert main([path, "--checkpoint", scratch + "/ckpt", "--explain"]) == 2  # batch only


def test_spec_values_validated_at_build():
    base = {"source": {"format": "csv", "path": "/x", "schema": "a string"},
            "sink": {"path": "/y"}}
    for bad in ({"stamps": {"ts_type": "date"}},
                {"quality": {"warn_pct": 150}},
                {"ingest": {"checkpoint": "/c", "max_files_per_batch": 0},
                 "sink": {"path": "/y", "mode": "append"}},
                {"sink": {"path": "/y", "max_records_per_file": -5}}):
        with pytest.raises(SpecError):
            JobSpec.from_dict({**base, **bad})


def test_ingest_counts_more_batches_than_spark_remembers(spark, scratch):
    from tidyframe.sinks.write import SinkSpec
    from tidyframe.sources.spec import SourceSpec
    from tidyframe.streaming.ingest import ingest_files, rows_written

    spark.range(0, 105, 1, 105).write.parquet(f"{scratch}/in")
    n = sum(1 for f in os.listdir(f"{scratch}/in") if f.endswith(".parquet"))
    query = ingest_files(spark, SourceSpec(format="parquet", path=f"{scratch}/in", schema="id long"),
                         SinkSpec(path=f"{scratch}/out", mode="append"), f"{scratch}/ckpt", max_files_per_batch=1)
    assert n > 100 and rows_written(query) == 105 == spark.read.parquet(f"{scratch}/out").count()


def test_ingest_csv_keeps_spaces(spark, scratch):
    from tidyframe.sinks.write import SinkSpec
    from tidyframe.sources.spec import SourceSpec
    from tidyframe.streaming.ingest import ingest_files

    spark.createDataFrame([("  x  ",), ("y ",)], "s string").write.parquet(f"{scratch}/in")
    ingest_files(spark, SourceSpec(format="parquet", path=f"{scratch}/in", schema="s string"),
                 SinkSpec(path=f"{scratch}/out", format="csv", mode="append"), f"{scratch}/ckpt")
    back = spark.read.csv(f"{scratch}/out", schema="s string", ignoreLeadingWhiteSpace=False,
                          ignoreTrailingWhiteSpace=False)
    assert sorted(r["s"] for r in back.collect()) == ["  x  ", "y "]


def test_legacy_jdbc_source(scratch):
    attrs = legacy_attrs("", scratch + "/out")
    attrs["source"] = {"file_type": "postgresql"}
    attrs |= {"tabela": "public.visits", "conexao": "jdbc:postgresql://db/ward", "driver": "org.postgresql.Driver"}
    src = from_legacy_attributes(attrs).source
    assert (src.format, src.table, src.url, src.driver) == (
        "postgresql", "public.visits", "jdbc:postgresql://db/ward", "org.postgresql.Driver")
    del attrs["driver"]
    with pytest.raises(SpecError, match="driver"):
        from_legacy_attributes(attrs)


def test_ingest_schema_is_kept_with_the_checkpoint(spark, scratch):
    from tidyframe.sources.spec import SourceSpec
    from tidyframe.streaming.ingest import schema_from_files

    spark.range(3).selectExpr("id", "'x' AS name").write.parquet(scratch + "/landing/a")
    found = schema_from_files(spark, SourceSpec("parquet", scratch + "/landing/a"), scratch + "/ck")
    gone = SourceSpec("parquet", scratch + "/empty/*.parquet")
    assert schema_from_files(spark, gone, scratch + "/ck") == found
    with pytest.raises(SpecError, match="source.schema"):
        schema_from_files(spark, gone, scratch + "/other")


def _conversions(report):
    return {r["subject"]: r["value"] for r in report.filter("check = 'conversion'").collect()}


def test_conversions_of_derived_columns(spark, scratch):
    df = spark.createDataFrame(
        [("1/x", "3", "2000-01-01"), ("y", "z", "soon"), (None, None, None), ("2/4", "5", "1999-05-05")],
        "pair string, Temp string, born string")
    df.write.parquet(scratch + "/in")
    spec = JobSpec.from_dict({
        "source": {"format": "parquet", "path": scratch + "/in"},
        "sink": {"path": scratch + "/out"},
        "clean": {"split": [{"column": "pair", "into": ["a", "b"], "cast": "int"}]},
        # a name in another case, and a column that the split has consumed
        "cast": [{"columns": ["temp", "pair"], "to": "double"}],
        "years_between": [{"column": "age", "start": "born", "end": "2024-01-01"}],
        "stamps": None, "quality": {},
    })
    result = run_job(spark, spec, *RUN)
    assert _conversions(result.report) == {"Temp": 1.0, "a": 1.0, "b": 1.0, "age": 1.0}
    rows = {(r["a"], r["b"], r["Temp"], r["age"]) for r in spark.read.parquet(scratch + "/out").collect()}
    assert rows == {(1, None, 3.0, 24), (None, None, None, None), (2, 4, 5.0, 24)}


def test_years_between_on_error_fail(spark, scratch):
    spark.createDataFrame([("soon",)], "born string").write.parquet(scratch + "/in")
    step = {"column": "age", "start": "born", "end": "2024-01-01", "on_error": "fail"}
    spec = JobSpec.from_dict({"source": {"format": "parquet", "path": scratch + "/in"},
                              "sink": {"path": scratch + "/out"}, "years_between": [step]})
    with pytest.raises(Exception, match="cannot parse date"):
        run_job(spark, spec, *RUN)
    with pytest.raises(SpecError, match="on_error"):
        JobSpec.from_dict({"source": {"format": "parquet", "path": "x"}, "sink": {"path": "y"},
                           "years_between": [{**step, "on_error": "skip"}]})
