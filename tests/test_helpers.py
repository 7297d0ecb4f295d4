"""Small pure-Python helpers (no Spark needed except where noted)."""

from __future__ import annotations

import re

from tidyframe.functions.split import literal_pattern
from tidyframe.operators._sql import pct_sql, quote_ident, sql_double, sql_str
from tidyframe.operators.dedupe import SortKey
from tidyframe.sources.spec import normalize_options


def test_literal_pattern_quotes_any_separator():
    for sep in ["/", ".", "|", "a+b", "(x)", "\\", "$^"]:
        assert re.fullmatch(r"\\Q.*\\E", literal_pattern(sep), re.S)
    tricky = literal_pattern("a\\Eb")  # contains the quote terminator
    assert "\\Q" not in tricky and tricky == "a\\\\Eb"


def test_sort_key_parsing():
    assert SortKey.parse("updated_at") == SortKey("updated_at", False, None)
    assert SortKey.parse(" updated_at DESC ") == SortKey("updated_at", True, None)
    assert SortKey.parse("-x nulls first") == SortKey("x", True, True)
    assert SortKey.parse("col with space asc nulls last") == SortKey("col with space", False, False)


def test_options_become_strings():
    assert normalize_options({"header": True, "n": 5, "x": False}) == {
        "header": "true", "n": "5", "x": "false"}
    assert normalize_options(None) == {}


def test_sql_literals():
    assert quote_ident("a`b.c") == "`a``b.c`"
    assert sql_str("it's \\ here") == "'it\\'s \\\\ here'"
    assert sql_double(1.5) == "1.5D" and sql_double(float("inf")) == "CAST('Infinity' AS DOUBLE)"
    assert sql_double(float("nan")) == "CAST('NaN' AS DOUBLE)"
    assert "100.0D" in pct_sql("a", "b")


def test_split_with_quote_terminator(spark):
    from tidyframe.functions import split_column

    df = spark.createDataFrame([("x\\Ey\\Ez",)], "s string")
    out = split_column(df, "s", ["a", "b", "c"], "\\E")
    assert tuple(out.first()) == ("x", "y", "z")
