"""Sources and sinks: round trips, globs, save modes, layouts, spec checks."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import SF_SMALL, plan_text
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidyframe.errors import SpecError
from tidyframe.sinks import SinkSpec, write_sink
from tidyframe.sources import SourceSpec, read_source
from tidyframe.sources.read import jdbc_options

VITALS = [
    ("100001", "  Ana   Souza ", "25/07/1936", "120/80", "36.5"),
    ("100002", "José da Silva", "31/02/2000", "130/90", "abc"),
    ("100001", "Ana Souza", "25/07/1936", "120/80", "36.5"),
]
VITALS_DDL = "id string, name string, birth string, bp string, temp string"


def _files(path, suffix):
    return [f for f in os.listdir(path) if f.endswith(suffix)]


@pytest.mark.parametrize(
    "fmt,opts",
    [("csv", {"header": True}), ("json", {}), ("parquet", {}), ("xml", {"rowTag": "row"})],
)
def test_roundtrip_formats(spark, scratch, fmt, opts):
    df = spark.createDataFrame(VITALS, VITALS_DDL)
    write_sink(df, SinkSpec(path=f"{scratch}/{fmt}", format=fmt, options=opts))
    back = read_source(spark, SourceSpec(format=fmt, path=f"{scratch}/{fmt}", options=opts,
                                         schema=VITALS_DDL))
    assert sorted(map(tuple, back.collect())) == sorted(VITALS)


def test_csv_keeps_surrounding_whitespace(spark, scratch):
    df = spark.createDataFrame([("  a  ",)], "s string")
    write_sink(df, SinkSpec(path=scratch + "/c", format="csv"))
    back = read_source(spark, SourceSpec(format="csv", path=scratch + "/c", schema="s string"))
    assert back.first()["s"] == "  a  "


def test_csv_without_schema_reads_strings(spark, scratch):
    df = spark.createDataFrame([(1, 2.5)], "a int, b double")
    write_sink(df, SinkSpec(path=scratch + "/c", format="csv", options={"header": True}))
    back = read_source(spark, SourceSpec(format="csv", path=scratch + "/c",
                                         options={"header": "true"}))
    assert back.dtypes == [("a", "string"), ("b", "string")]


def test_glob_unions_files_with_lineage(spark, scratch):
    df = spark.createDataFrame(VITALS, VITALS_DDL)
    for day in ("20231024", "20231024_011043"):
        write_sink(df, SinkSpec(path=f"{scratch}/vitals_{day}.csv", format="csv",
                                options={"header": True}))
    spec = SourceSpec(format="csv", path=f"{scratch}/vitals_*.csv", options={"header": True},
                      schema=VITALS_DDL, file_path_col="src")
    back = read_source(spark, spec)
    assert back.count() == 6
    assert back.select(F.regexp_extract("src", r"vitals_([0-9_]+)\.csv", 1)).distinct().count() == 2


def test_parquet_pushdown_and_pruning(spark):
    spec = SourceSpec(format="parquet", path=f"{SF_SMALL}/lineitem.parquet")
    df = read_source(spark, spec).filter(F.col("l_quantity") > 10).select("l_orderkey")
    plan = plan_text(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_source_spec_validation():
    with pytest.raises(SpecError):
        SourceSpec(format="avro", path="/x")
    with pytest.raises(SpecError):
        SourceSpec(format="xml", path="/x")  # rowTag is mandatory
    with pytest.raises(SpecError):
        SourceSpec(format="csv")
    with pytest.raises(SpecError):
        SourceSpec.from_dict({"file_type": "csv", "file_path": "/x", "tabela": "t"})
    s = SourceSpec.from_dict({"file_type": "CSV", "file_path": "/x", "options": {"header": True}})
    assert s.format == "csv" and s.options == {"header": "true"}


def test_jdbc_spec_and_options():
    base = {"format": "postgresql", "url": "jdbc:postgresql://db/x", "driver": "org.postgresql.Driver"}
    with pytest.raises(SpecError):
        SourceSpec(**{**base, "url": None, "table": "t"})
    with pytest.raises(SpecError):
        SourceSpec(**base)  # neither table nor query
    with pytest.raises(SpecError):
        SourceSpec(**base, table="t", query="select 1")
    with pytest.raises(SpecError):
        SourceSpec(**base, table="t", partition_column="id", num_partitions=8)
    spec = SourceSpec(**base, table="t", partition_column="id", lower_bound=0,
                      upper_bound=1000, num_partitions=8, fetchsize=5000,
                      options={"user": "u"})
    opts = jdbc_options(spec)
    assert opts == {
        "user": "u", "url": "jdbc:postgresql://db/x", "driver": "org.postgresql.Driver",
        "dbtable": "t", "partitionColumn": "id", "lowerBound": "0", "upperBound": "1000",
        "numPartitions": "8", "fetchsize": "5000",
    }
    for kind in ("sqlite", "mysql", "sqlserver", "jdbc"):
        assert SourceSpec(**{**base, "format": kind}, query="select 1").is_jdbc


def test_sink_spec_validation():
    with pytest.raises(SpecError):
        SinkSpec(path="/x", format="avro")
    with pytest.raises(SpecError):
        SinkSpec(path="/x", mode="upsert")
    with pytest.raises(SpecError):
        SinkSpec(path="/x", options={"mode": "append"})  # mode is a field
    with pytest.raises(SpecError):
        SinkSpec(path="/x", format="csv", options={"sep": ""})
    with pytest.raises(SpecError):
        SinkSpec(path="/x", format="xml")
    assert SinkSpec(path="/x", partition_by="d").partition_by == ("d",)


def _daily(spark, day, n=3):
    return spark.range(n).select(F.col("id"), F.lit(dt.date.fromisoformat(day)).alias("d"))


def test_modes_append_overwrite_error_ignore(spark, scratch):
    path = scratch + "/t"
    df = _daily(spark, "2024-01-01")
    write_sink(df, SinkSpec(path=path, mode="append"))
    write_sink(df, SinkSpec(path=path, mode="append"))
    assert spark.read.parquet(path).count() == 6
    write_sink(df, SinkSpec(path=path, mode="overwrite"))
    assert spark.read.parquet(path).count() == 3
    write_sink(_daily(spark, "2024-01-01", 10), SinkSpec(path=path, mode="ignore"))
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(AnalysisException):
        write_sink(df, SinkSpec(path=path, mode="error"))


def test_dynamic_overwrite_keeps_other_days(spark, scratch):
    path = scratch + "/p"
    sink = SinkSpec(path=path, partition_by=("d",), dynamic_overwrite=True)
    write_sink(_daily(spark, "2024-01-01"), sink)
    write_sink(_daily(spark, "2024-01-02"), sink)
    write_sink(_daily(spark, "2024-01-02", 5), sink)
    counts = {r["d"]: r["count"] for r in spark.read.parquet(path).groupBy("d").count().collect()}
    assert counts == {dt.date(2024, 1, 1): 3, dt.date(2024, 1, 2): 5}
    # unless asked for, overwrite replaces the whole folder
    write_sink(_daily(spark, "2024-01-03"), SinkSpec(path=path, partition_by=("d",)))
    assert spark.read.parquet(path).select("d").distinct().count() == 1


def test_layout_file_counts(spark, scratch):
    df = spark.range(1000).repartition(7)
    write_sink(df, SinkSpec(path=scratch + "/one", num_files=1))
    write_sink(df, SinkSpec(path=scratch + "/four", num_files=4))
    write_sink(df, SinkSpec(path=scratch + "/many", num_files=None))
    assert len(_files(scratch + "/one", ".parquet")) == 1
    assert len(_files(scratch + "/four", ".parquet")) == 4
    assert len(_files(scratch + "/many", ".parquet")) == 7
    assert spark.read.parquet(scratch + "/four").count() == 1000


def test_partitioned_write_uses_rebalance(spark, scratch):
    df = _daily(spark, "2024-01-01", 100)
    from tidyframe.sinks import prepare_layout

    plan = plan_text(prepare_layout(df, SinkSpec(path=scratch, partition_by=("d",))))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_max_records_per_file(spark, scratch):
    write_sink(spark.range(100).repartition(1), SinkSpec(path=scratch + "/m",
                                                         max_records_per_file=30))
    assert len(_files(scratch + "/m", ".parquet")) == 4


@pytest.mark.parametrize("parallel", ["bounds", "predicates"])
def test_jdbc_reader_wiring_without_database(spark, parallel):
    """The spec reaches Spark's JDBC reader; with a driver class that is not
    on the classpath Spark fails while loading it, before any connection."""
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError

    extra = ({"partition_column": "id", "lower_bound": 0, "upper_bound": 100,
              "num_partitions": 4} if parallel == "bounds"
             else {"predicates": ["id < 50", "id >= 50"]})
    spec = SourceSpec(format="postgresql", url="jdbc:postgresql://db.invalid/x",
                      driver="org.example.NoSuchDriver", table="t", **extra)
    with pytest.raises((PySparkException, Py4JJavaError)) as err:
        read_source(spark, spec).schema
    assert "NoSuchDriver" in str(err.value)


def test_static_overwrite_wins_over_session_default(spark, scratch):
    path = scratch + "/p"
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        write_sink(_daily(spark, "2024-01-01"), SinkSpec(path=path, partition_by=("d",)))
        write_sink(_daily(spark, "2024-01-02"), SinkSpec(path=path, partition_by=("d",),
                                                         dynamic_overwrite=False))
        assert spark.read.parquet(path).select("d").distinct().count() == 1
    finally:
        spark.conf.set(key, old)


def test_partition_pruning_on_written_layout(spark, scratch):
    path = scratch + "/p"
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        write_sink(_daily(spark, day), SinkSpec(path=path, partition_by=("d",), dynamic_overwrite=True))
    df = read_source(spark, SourceSpec(format="parquet", path=path))
    one = df.filter(F.col("d") == F.lit(dt.date(2024, 1, 2)))
    plan = plan_text(one)
    assert "PartitionFilters: [isnotnull(d" in plan and "= 2024-01-02" in plan
    assert one.count() == 3


def test_rebalance_splits_a_hot_partition_value(spark, scratch):
    """One partition value holds a third of the rows: with the rebalance hint
    AQE writes it with several tasks (files), not one."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        df = spark.range(300000).select(
            F.col("id"),
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string"))
            .alias("bucket"),
        )
        write_sink(df, SinkSpec(path=scratch + "/w", partition_by=("bucket",)))
    finally:
        spark.conf.set(key, old)
    hot_files = _files(scratch + "/w/bucket=hot", ".parquet")
    assert len(hot_files) > 1
    assert spark.read.parquet(scratch + "/w").filter("bucket = 'hot'").count() == 100000


def test_csv_malformed_rows_captured(spark, scratch):
    path = scratch + "/bad.csv"
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w", encoding="utf-8") as fh:
        fh.write("id,temp\n1,36.5\n2,abc\n3,37.0,extra\n")
    spec = SourceSpec(format="csv", path=path,
                      options={"header": True, "mode": "PERMISSIVE",
                               "columnNameOfCorruptRecord": "_bad"},
                      schema="id int, temp double, _bad string")
    rows = sorted(read_source(spark, spec).collect(), key=lambda r: r["id"])
    assert [r["temp"] for r in rows] == [36.5, None, 37.0]
    assert rows[0]["_bad"] is None and rows[1]["_bad"] == "2,abc"
    fail = SourceSpec(format="csv", path=path, options={"header": True, "mode": "FAILFAST"},
                      schema="id int, temp double")
    with pytest.raises(Exception):
        read_source(spark, fail).collect()


def test_inference_without_schema_warns(spark, scratch):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    write_sink(df, SinkSpec(path=scratch + "/j", format="json"))
    with pytest.warns(UserWarning, match="scans the whole input"):
        back = read_source(spark, SourceSpec(format="json", path=scratch + "/j"))
    assert back.count() == 1


def test_csv_encoding_option(spark, scratch):
    path = scratch + "/latin1"
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w", encoding="iso-8859-1") as fh:
        fh.write("id;nome\n1;José Conceição\n2;Ângela\n")
    spec = SourceSpec(format="csv", path=path,
                      options={"header": True, "sep": ";", "encoding": "ISO-8859-1"},
                      schema="id int, nome string")
    got = sorted(tuple(r) for r in read_source(spark, spec).collect())
    assert got == [(1, "José Conceição"), (2, "Ângela")]
    wrong = SourceSpec(format="csv", path=path, options={"header": True, "sep": ";"},
                       schema="id int, nome string")
    assert sorted(tuple(r) for r in read_source(spark, wrong).collect()) != got


def test_jdbc_query_with_predicates_is_rejected():
    with pytest.raises(SpecError):
        SourceSpec(format="jdbc", url="jdbc:x", driver="d", query="select 1", predicates=("a = 1",))
