"""Files of a target size: counts, ranges, odd values."""

from __future__ import annotations

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from tidyframe.errors import SpecError
from tidyframe.sinks import SinkSpec, write_sink


def files(spark, path, keys=()):
    back = spark.read.parquet(path)
    return back.groupBy(*keys, F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()


def test_sizes_by_partition_value(spark, scratch):
    df = spark.range(9000).selectExpr(
        "id as x", "case when id % 3 < 2 then 'hot' when id % 90 = 2 then null else 'b' end as p", "'abcdefgh' as t")
    sink = SinkSpec(path=f"{scratch}/a", partition_by=("p",), target_file_bytes=16_000)  # 16 bytes a row
    write_sink(df, sink)
    got = files(spark, sink.path, ["p"])
    assert sorted(((r["p"] or ""), r["n"] > 0) for r in got) == \
        [("", True)] + [("b", True)] * 3 + [("hot", True)] * 6
    hot = [r["n"] for r in got if r["p"] == "hot"]
    assert sum(hot) == 6000 and max(hot) < 1.3 * 1000
    back = spark.read.parquet(sink.path)
    assert back.count() == 9000 and back.exceptAll(df.select("x", "t", "p").select(back.columns)).count() == 0


def test_clustered_files_are_ranges(spark, scratch):
    df = spark.range(20_000).selectExpr("(id * 7919) % 20000 as x").repartition(5)
    for target, many in ((8_000, 20), (500, 320)):  # 8 bytes a row; more files than quantiles
        path = f"{scratch}/c{target}"
        write_sink(df, SinkSpec(path=path, target_file_bytes=target, cluster_by="x"))
        got = sorted(files(spark, path), key=lambda r: (r["low"], r["high"]))
        assert abs(len(got) - many) <= (0 if many < 200 else many // 20)
        if many < 200:
            assert all(a["high"] <= b["low"] for a, b in zip(got, got[1:], strict=False))
            assert max(r["n"] for r in got) < 1.3 * 1000


def test_one_cluster_value_fills_several_files(spark, scratch):
    df = spark.range(10_000).selectExpr("case when id % 4 = 0 then id when id % 40 = 1 then null else 5 end as x",
                                        "id as y")
    write_sink(df, SinkSpec(path=f"{scratch}/d", target_file_bytes=16_000, cluster_by="x"))
    got = files(spark, f"{scratch}/d")
    assert len(got) == 10 and max(r["n"] for r in got) < 1.5 * 1000
    assert sum(r["n"] for r in got) == 10_000


def test_plan_empty_input_and_rules(spark, scratch):
    sink = SinkSpec(path=f"{scratch}/e", partition_by=("p",), target_file_bytes=10)
    write_sink(spark.createDataFrame([], "x int, p string"), sink)
    assert spark.read.schema("x int, p string").parquet(f"{scratch}/e").count() == 0
    nested = spark.createDataFrame([(1, {"a": 1}, [1, 2])], "x int, m map<string,int>, l array<int>")
    write_sink(nested, SinkSpec(path=f"{scratch}/n", target_file_bytes=10))
    assert spark.read.parquet(f"{scratch}/n").count() == 1
    from tidyframe.sinks.write import prepare_layout

    plan = plan_text(prepare_layout(spark.range(10).selectExpr("id as x"), SinkSpec(
        path="/x", target_file_bytes=8, cluster_by="x")), "simple")
    assert plan.count("Exchange") == 2  # the one-row plan and the rows, once
    for bad in ({"target_file_bytes": 0}, {"target_file_bytes": 5, "num_files": 2}, {"cluster_by": "x"}):
        with pytest.raises(SpecError):
            SinkSpec(path="/x", **bad)
    with pytest.raises(SpecError):
        write_sink(nested, SinkSpec(path=f"{scratch}/z", target_file_bytes=10, cluster_by="m"))
