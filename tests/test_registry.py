"""Every registered query equals its DuckDB oracle (sf0.001 tables): same
columns, same row count, same values (floats bit for bit)."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest
from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    s_rows = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()], strict=True)
    rel = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    d_rows = rows_of(cols, rel.fetchall(), strict=True)
    assert sorted(sdf.columns) == sorted(cols)
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["column", "total", "n_null", "n_filled", "pct_null", "pct_filled", "status"]
    assert df.count() == 5
