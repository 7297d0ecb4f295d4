"""CSV files whose headers differ, and JDBC reader options."""

from __future__ import annotations

import os
import warnings

import pytest

from tidyframe.errors import SpecError
from tidyframe.sources import SourceSpec, read_source
from tidyframe.sources.headers import file_headers, header_names

DDL = "id int, v string, w double"


@pytest.fixture
def files(scratch):
    def put(name, text):
        path = os.path.join(scratch, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8", newline="") as fh:
            fh.write(text)

    put("a.csv", "id,v,w\n1,x,1.5\n2,y,\n")
    put("b c.csv", "w,id,v\r\n2.5,3,z\r\n")              # another order, a space in the name
    put("c[1].csv", '﻿"v","ID"\n"a,b",4\n')          # no w, another case, a mark, glob signs
    put("d.csv", "\n# note\nid,v,w\n5,q,5.5\n")           # a blank line and a comment first
    put("e.csv", "")
    put("f.csv", "v,w,id\n")                              # a header alone
    return scratch


def spec(path, schema=DDL, **more):
    options = {"header": True, "comment": "#", **more.pop("options", {})}
    return SourceSpec(format="csv", path=path, options=options, schema=schema, headers="by_name", **more)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


WANT = [(1, "x", 1.5), (2, "y", None), (3, "z", 2.5), (4, "a,b", None), (5, "q", 5.5)]


def test_files_are_read_by_their_own_headers(spark, files):
    df = read_source(spark, spec(f"{files}/*.csv"))
    assert df.dtypes == [("id", "int"), ("v", "string"), ("w", "double")]
    assert got(df) == WANT
    assert got(read_source(spark, spec(files))) == WANT
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert len(file_headers(spark, spec(files))) == 5
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_without_a_schema_all_names_are_united_as_text(spark, files):
    df = read_source(spark, spec(f"{files}/*.csv", None, file_path_col="src"))
    assert df.columns == ["id", "v", "w", "src"]
    assert got(df.select("id", "v", "w")) == [("1", "x", "1.5"), ("2", "y", None), ("3", "z", "2.5"),
                                             ("4", "a,b", None), ("5", "q", "5.5")]
    assert {r["src"].rsplit("/", 1)[1] for r in df.collect()} == {"a.csv", "b%20c.csv", "c%5B1%5D.csv", "d.csv"}


def test_unknown_columns(spark, files):
    few = "id int, w double"
    with pytest.raises(SpecError, match="not in the schema"):
        read_source(spark, spec(f"{files}/*.csv", few))
    dropped = read_source(spark, spec(f"{files}/*.csv", few, unknown_columns="drop"))
    assert got(dropped) == [(a, c) for a, _, c in WANT]
    kept = read_source(spark, spec(f"{files}/*.csv", few, unknown_columns="keep"))
    assert kept.columns == ["id", "w", "v"] and got(kept) == [(a, c, b) for a, b, c in WANT]


def test_case_rule_of_the_session(spark, files):
    own = spark.newSession()
    own.conf.set("spark.sql.caseSensitive", "true")
    df = read_source(own, spec(f"{files}/*.csv", None))
    assert df.columns == ["id", "v", "w", "ID"]


def test_a_shifted_file_fails_by_default(spark, files):
    plain = {"format": "csv", "path": [f"{files}/a.csv", f"{files}/b c.csv"], "options": {"header": True}, "schema": DDL}
    with pytest.raises(Exception, match="header"):
        read_source(spark, SourceSpec(**plain)).collect()
    # the old way is still there for those who want it
    assert read_source(spark, SourceSpec(**plain, headers="position")).count() == 3


def test_empty_folder_and_twice_named_columns(spark, scratch):
    os.makedirs(f"{scratch}/none")
    assert got(read_source(spark, spec(f"{scratch}/none"))) == []
    with open(f"{scratch}/x.csv", "w") as fh:
        fh.write("a,A\n1,2\n")
    with pytest.raises(SpecError, match="twice"):
        read_source(spark, spec(f"{scratch}/x.csv", None))


def test_corrupt_record_column_and_partition_folders(spark, scratch):
    for day, text in (("1", "id,v\n1,a\n2,b,c\n"), ("2", "v,id\nz,nope\n")):
        os.makedirs(f"{scratch}/t/day={day}")
        with open(f"{scratch}/t/day={day}/f.csv", "w") as fh:
            fh.write(text)
    df = read_source(spark, spec(f"{scratch}/t", "id int, v string, _corrupt_record string"))
    rows = {(r["day"], r["v"]): (r["id"], r["_corrupt_record"]) for r in df.collect()}
    assert rows == {(1, "a"): (1, None), (1, "b"): (2, "2,b,c"), (2, "z"): (None, "z,nope")}


def test_header_names():
    assert header_names("a;b c; d", {"sep": ";"}) == ["a", "b c", " d"]
    assert header_names('"a""b",c,', {"escape": '"'}) == ['a"b', "c", "_c2"]
    assert header_names("a\tb", {"sep": "\\t"}) == ["a", "b"]
    assert header_names(" a , b", {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}) == ["a", "b"]


def test_spec_rules():
    for bad in ({"headers": "other"}, {"headers": "by_name"}, {"unknown_columns": "x"},
                {"headers": "by_name", "options": {"header": True, "inferSchema": True}}):
        with pytest.raises(SpecError):
            SourceSpec(format="csv", path="/x", **bad)


# -------------------------------------------------------------------------- JDBC


class FakeReader:
    """Records what a JDBC reader is asked for."""

    def __init__(self):
        self.opts, self.jdbc_call = {}, None

    def format(self, name):
        return self

    def options(self, **opts):
        self.opts.update(opts)
        return self

    def load(self):
        return self

    def jdbc(self, url, table, predicates, properties):
        self.jdbc_call = (url, table, predicates, properties)
        return self


class FakeSpark:
    def __init__(self):
        self.read = FakeReader()


BASE = {"format": "postgresql", "url": "jdbc:postgresql://h/db", "driver": "d", "table": "t"}


def test_jdbc_schema_goes_with_predicates():
    spark = FakeSpark()
    read_source(spark, SourceSpec(**BASE, schema="id long", predicates=["a = 1", "a <> 1"]))
    url, table, predicates, properties = spark.read.jdbc_call
    assert (url, table, predicates) == ("jdbc:postgresql://h/db", "t", ["a = 1", "a <> 1"])
    assert properties["customSchema"] == "id long"


def test_jdbc_in_one_task_warns():
    with pytest.warns(UserWarning, match="one task"):
        read_source(FakeSpark(), SourceSpec(**BASE))
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        read_source(FakeSpark(), SourceSpec(**BASE, partition_column="id", lower_bound=0, upper_bound=9,
                                            num_partitions=2))
        read_source(FakeSpark(), SourceSpec(**BASE, predicates=["true"]))
