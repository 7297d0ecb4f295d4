"""De-duplication and quality metrics: edge rows, determinism, plan shape."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from conftest import SF_SMALL, count_jobs, plan_text
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidyframe.errors import MissingColumnError, SpecError
from tidyframe.operators import (
    completeness,
    dedupe_report,
    describe_numeric,
    duplicate_metrics,
    keep_one,
    quality_report,
    range_check,
)

NAN = float("nan")


# ---------------------------------------------------------------------- dedupe


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 4), (2, 5)], "k int, v int")
    for strategy in ("window", "aggregate", "any"):
        order = None if strategy == "any" else ["v desc"]
        out = keep_one(df, ["k"], order, strategy=strategy)
        assert out.count() == 3
    latest = {r["k"]: r["v"] for r in keep_one(df, ["k"], ["v desc"]).collect()}
    assert latest == {None: 2, 1: 4, 2: 5}


def test_survivor_deterministic_without_order(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 9.0), (1, "a", 1.0)], "k int, s string, x double")
    a = keep_one(df, ["k"], strategy="window").collect()
    b = keep_one(df.repartition(3), ["k"], strategy="aggregate").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b] == [(1, "a", 1.0)]


def test_mixed_directions_with_text(spark):
    df = spark.createDataFrame([(1, 1, "z"), (1, 1, "a"), (1, 0, "q")], "k int, p int, s string")
    for strategy in ("window", "aggregate"):
        out = keep_one(df, ["k"], ["p desc", "s asc"], strategy=strategy)
        assert [tuple(r) for r in out.collect()] == [(1, 1, "a")]
    nested = df.selectExpr("k", "p", "array(s) as s")
    assert keep_one(nested, ["k"], ["p desc", "s asc"]).first()["s"] == ["a"]
    with pytest.raises(SpecError):  # nested values have no inverted form
        keep_one(nested, ["k"], ["p desc", "s asc"], strategy="aggregate")
    plan = plan_text(keep_one(df, ["k"], ["p desc", "s asc"], strategy="aggregate", count_col="n"), "simple")
    assert plan.count("Exchange") == 1  # rows and counts in one shuffle


def test_count_col_reports_rows_per_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "k int, v int")
    out = {r["k"]: (r["v"], r["n"]) for r in keep_one(df, ["k"], ["v desc"], count_col="n").collect()}
    assert out == {1: (2, 2), 2: (3, 1)}


def test_keep_one_validates(spark):
    df = spark.createDataFrame([(1, 1)], "k int, v int")
    with pytest.raises(SpecError):
        keep_one(df, [])
    with pytest.raises(MissingColumnError):
        keep_one(df, ["nope"])
    with pytest.raises(MissingColumnError):
        keep_one(df, ["k"], ["nope desc"])


rows = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3), st.sampled_from(["a", "b", None])),
    min_size=0, max_size=30,
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows)
def test_strategies_agree_with_python(spark, data):
    df = spark.createDataFrame(data, "k int, t int, s string")
    want = {}
    for k, t, s in data:  # latest t, ties by s descending, None lowest
        cur = want.get(k)
        key = (t, s is not None, s or "")
        if cur is None or key > (cur[0], cur[1] is not None, cur[1] or ""):
            want[k] = (t, s)
    for strategy in ("window", "aggregate"):
        got = {r["k"]: (r["t"], r["s"]) for r in keep_one(df, ["k"], ["t desc"], strategy=strategy).collect()}
        assert got == want


def test_dedupe_reduces_before_shuffle(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    win = plan_text(keep_one(orders, ["o_custkey"], ["o_orderdate desc"], strategy="window"))
    agg = plan_text(keep_one(orders, ["o_custkey"], ["o_orderdate desc"], strategy="aggregate"))
    # a partial (map-side) step sits below the exchange in both plans
    assert "WindowGroupLimit" in win and "Partial" in win
    assert "partial_max(" in agg and "max_by" not in agg


def test_dedupe_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    r = dedupe_report(df, ["a", "b"]).first().asDict()
    assert r == {"rows_before": 5, "rows_after": 3, "rows_removed": 2, "pct_removed": 40.0}
    empty = spark.createDataFrame([], "a int, b int")
    assert dedupe_report(empty, ["a"]).first().asDict() == {
        "rows_before": 0, "rows_after": 0, "rows_removed": 0, "pct_removed": 0.0}


# --------------------------------------------------------------------- quality


def _frame(spark):
    return spark.createDataFrame(
        [(1, "a", 36.5), (2, None, NAN), (3, "c", None), (3, "d", 50.0), (None, "e", 35.0)],
        "id int, name string, temp double",
    )


def test_completeness_nulls_and_nan(spark):
    rep = {r["column"]: r.asDict() for r in completeness(_frame(spark)).collect()}
    assert rep["id"]["n_null"] == 1 and rep["id"]["status"] == "fail"  # 20 %
    assert rep["name"]["n_null"] == 1
    assert rep["temp"]["n_null"] == 2 and rep["temp"]["pct_null"] == 40.0
    assert rep["temp"]["pct_filled"] == 60.0 and rep["temp"]["n_filled"] == 3


def test_completeness_status_thresholds(spark):
    df = spark.range(100).selectExpr("case when id < 5 then null else id end as x", "id as y")
    rep = {r["column"]: r["status"] for r in completeness(df).collect()}
    assert rep == {"x": "warn", "y": "ok"}


def test_completeness_empty_table(spark):
    empty = spark.createDataFrame([], "a int, b string")
    rep = completeness(empty).collect()
    assert [(r["total"], r["pct_null"], r["pct_filled"]) for r in rep] == [(0, 0.0, 0.0)] * 2


def test_range_check_null_nan_bounds(spark):
    df = spark.createDataFrame([(35.0,), (42.0,), (34.9,), (None,), (NAN,), (40.0,)], "t double")
    r = range_check(df, [{"column": "t", "min": 35, "max": 42}]).first().asDict()
    assert (r["total"], r["n_valid"], r["n_invalid"], r["n_null"]) == (6, 3, 2, 1)
    legacy = range_check(df, [{"column": "t", "min": 35, "max": 42}], legacy_null_valid=True).first()
    assert legacy["n_valid"] == 4
    with pytest.raises(SpecError):
        range_check(df, [{"column": "t", "min": 5, "max": 1}])
    with pytest.raises(SpecError):
        range_check(df, [{"coluna": "t", "min": 1, "max": 5}])


def test_duplicate_metrics_null_key_counts_once(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,), (2,)], "k int")
    r = duplicate_metrics(df, ["k"]).first().asDict()
    assert (r["total"], r["n_unique"], r["n_duplicate"]) == (5, 3, 2)


def test_describe_numeric(spark):
    d = {r["column"]: r for r in describe_numeric(_frame(spark)).collect()}
    assert set(d) == {"id", "temp"}
    assert d["id"]["count"] == 4 and d["id"]["min"] == 1.0 and d["id"]["max"] == 3.0
    assert math.isnan(d["temp"]["mean"])  # NaN propagates, like describe()


def test_metrics_job_count_is_constant(spark):
    """One aggregate whatever the column / rule count (AQE runs it as a map
    stage job plus a result job); a per-column loop would launch N jobs."""

    def frame(n):
        return spark.range(1000).selectExpr(
            *[f"case when id % {k} = 0 then null else id end as c{k}" for k in range(2, 2 + n)])

    def rules(n):
        return [{"column": f"c{k}", "min": 0, "max": 500} for k in range(2, 2 + n)]

    narrow, wide = frame(2), frame(28)
    jobs_narrow = count_jobs(spark, lambda: completeness(narrow).collect())
    assert jobs_narrow <= 2
    assert count_jobs(spark, lambda: completeness(wide).collect()) == jobs_narrow
    assert count_jobs(spark, lambda: range_check(wide, rules(28)).collect()) == jobs_narrow


def test_quality_report_long_form(spark):
    rep = quality_report(_frame(spark), keys=["id"], rules=[{"column": "temp", "min": 35, "max": 42}])
    got = {(r["check"], r["subject"], r["metric"]): r["value"] for r in rep.collect()}
    assert got[("completeness", "temp", "n_null")] == 2.0
    assert got[("duplicates", "id", "n_duplicate")] == 1.0
    assert got[("range", "temp", "n_invalid")] == 2.0
    assert got[("describe", "id", "max")] == 3.0
    assert rep.columns == ["check", "subject", "metric", "value"]


def test_hot_key_never_reaches_one_reducer_whole():
    """A third of all rows on one key: the event log shows no reduce task
    reading more than a small slice (map-side reduction before the shuffle)."""
    import json
    import subprocess
    import sys

    from conftest import ROOT, SF_CHECK

    out = subprocess.run(
        [sys.executable, f"{ROOT}/tools/skew_check.py", SF_CHECK],
        capture_output=True, text=True, timeout=600, check=True,
    ).stdout
    res = json.loads(out.strip().splitlines()[-1])
    assert res["hot_key_rows"] * 3 >= res["rows"] - 3
    for name, m in res["operators"].items():
        assert m["shuffle_records"] < res["rows"] / 3, name
        assert m["max_records_one_task"] < res["hot_key_rows"] / 2, name


def test_report_subjects_with_quotes_and_backslashes(spark):
    df = spark.createDataFrame([(1, None)], "`it's` int, `a\\\\b` string")
    rep = quality_report(df)
    subjects = {r["subject"] for r in rep.collect()}
    assert {"it's", "a\\\\b"} <= subjects


def test_range_open_ended_and_wide_table(spark):
    r = range_check(spark.createDataFrame([(1.0,), (-5.0,)], "x double"),
                    [{"column": "x", "min": float("-inf"), "max": 0.0}]).first()
    assert (r["min"], r["max"], r["n_valid"], r["n_invalid"]) == (float("-inf"), 0.0, 1, 1)
    wide = spark.range(10).selectExpr(*[f"id + {k} as c{k}" for k in range(300)])
    rep = completeness(wide).collect()
    assert len(rep) == 300 and all(x["n_null"] == 0 for x in rep)
    assert describe_numeric(wide).count() == 300


def test_awkward_column_names(spark, scratch):
    from tidyframe.functions import cast_columns, normalize_columns, split_column
    from tidyframe.operators import select_columns
    from tidyframe.sinks import SinkSpec, write_sink

    df = spark.createDataFrame(
        [("k1", " A  b ", "1.5", "x/y", "2024-01-01"), ("k1", "c", "bad", "z", "2024-01-02"),
         ("k2", None, "2", None, "2024-01-03")],
        "`a.b` string, `x y` string, `c``d` string, `s.p` string, `d.t` string",
    )
    out = (df.transform(normalize_columns, ["x y"])
             .transform(cast_columns, ["c`d"], "double")
             .transform(split_column, "s.p", ["s.1", "s 2"], "/", keep_source=True))
    assert [r["x y"] for r in out.collect()] == ["a b", "c", None]
    for strategy in ("window", "aggregate"):
        kept = keep_one(out, ["a.b"], ["d.t desc"], strategy=strategy)
        assert {r["a.b"]: r["d.t"] for r in kept.collect()} == {"k1": "2024-01-02", "k2": "2024-01-03"}
    rep = {(r["check"], r["subject"], r["metric"]): r["value"] for r in quality_report(
        out, keys=["a.b"], rules=[{"column": "c`d", "min": 0, "max": 1}]).collect()}
    assert rep[("completeness", "x y", "n_null")] == 1.0
    assert rep[("range", "c`d", "n_invalid")] == 2.0 and rep[("range", "c`d", "n_null")] == 1.0
    assert rep[("duplicates", "a.b", "n_duplicate")] == 1.0
    assert select_columns(out, ["s.1", "a.b"]).columns == ["s.1", "a.b"]
    write_sink(out, SinkSpec(path=scratch + "/w", partition_by=("a.b",)))
    assert spark.read.parquet(scratch + "/w").count() == 3


def test_approx_duplicates_single_pass(spark):
    df = spark.range(20000).selectExpr(
        "case when id % 1000 = 0 then null else id % 5000 end as k", "id")
    exact = duplicate_metrics(df, ["k"]).first()
    approx = duplicate_metrics(df, ["k"], approx=True).first()
    # k = 0, 1000, .., 4000 only occur on nulled rows: 4995 values + the NULL group
    assert exact["n_unique"] == 4996
    assert abs(approx["n_unique"] - exact["n_unique"]) / exact["n_unique"] < 0.05
    rep = quality_report(df, keys=["k"], approx_duplicates=True)
    plan = plan_text(rep)
    assert "Exchange hashpartitioning" not in plan  # no key shuffle at all
    got = {(r["check"], r["metric"]): r["value"] for r in rep.collect()}
    assert got[("duplicates", "total")] == 20000.0
    assert abs(got[("duplicates", "n_unique")] - 4996) / 4996 < 0.05


def test_order_by_nulls_placement(spark):
    from tidyframe.operators.dedupe import SortKey

    assert SortKey.parse("t desc nulls first") == SortKey("t", True, True)
    assert SortKey.parse("-t NULLS LAST") == SortKey("t", True, False)
    assert SortKey.parse("t nulls last") == SortKey("t", False, False)
    df = spark.createDataFrame([(1, None), (1, 5), (2, 3)], "k int, t int")
    default = {r["k"]: r["t"] for r in keep_one(df, ["k"], ["t desc"]).collect()}
    first = {r["k"]: r["t"] for r in keep_one(df, ["k"], ["t desc nulls first"]).collect()}
    assert default == {1: 5, 2: 3} and first == {1: None, 2: 3}
    asc_last = {r["k"]: r["t"] for r in keep_one(df, ["k"], ["t nulls last"]).collect()}
    assert asc_last == {1: 5, 2: 3}
    agg_first = {r["k"]: r["t"] for r in
                 keep_one(df, ["k"], ["t desc nulls first"], strategy="aggregate").collect()}
    assert agg_first == first


def _rows_close(a, b):
    if len(a) != len(b):
        return False
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            if isinstance(u, float) and isinstance(v, float):
                if math.isnan(u) and math.isnan(v):
                    continue
                if abs(u - v) > 1e-12 * max(1.0, abs(u), abs(v)):
                    return False
            elif u != v:
                return False
    return True


def _key_sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(map(str, t)))


def test_long_layout_equals_wide(spark):
    from decimal import Decimal

    data = [(1, 2.5, 1.5, Decimal("1.10"), "a", 7), (None, NAN, None, None, None, 9),
            (3, None, 2.0, Decimal("3.30"), "c", 11), (3, -1.0, NAN, Decimal("0.01"), "d", -4)]
    df = spark.createDataFrame(data, "i int, d double, f float, m decimal(10,2), s string, b bigint")
    empty = df.limit(0)
    rules = [{"column": "d", "min": 0, "max": 2}, {"column": "b", "min": 0, "max": 10},
             {"column": "m", "min": 1, "max": 5}]
    for frame in (df, empty):
        for legacy in (False, True):
            w = _key_sorted(range_check(frame, rules, legacy, layout="wide"))
            lg = _key_sorted(range_check(frame, rules, legacy, layout="long"))
            assert _rows_close(w, lg)
            w = _key_sorted(quality_report(frame, keys=["i"], rules=rules,
                                           legacy_null_valid=legacy, layout="wide"))
            lg = _key_sorted(quality_report(frame, keys=["i"], rules=rules,
                                            legacy_null_valid=legacy, layout="long"))
            assert _rows_close(w, lg)
        assert _key_sorted(completeness(frame, layout="wide")) == \
            _key_sorted(completeness(frame, layout="long"))
        assert _rows_close(_key_sorted(describe_numeric(frame, layout="wide")),
                           _key_sorted(describe_numeric(frame, layout="long")))
    with pytest.raises(SpecError):
        completeness(df, layout="tall")


def test_long_layout_is_one_scan(spark):
    wide = spark.range(100).selectExpr(*[f"cast(id + {k} as double) as c{k}" for k in range(150)])
    plan = plan_text(quality_report(wide), "simple")
    assert plan.count("Range (") == 1  # one scan of the input
    assert "inline" in plan.lower()


def test_drop_and_select_columns(spark):
    from tidyframe.operators import drop_columns, select_columns

    df = spark.createDataFrame([(1, 2, 3)], "a int, `b.c` int, d int")
    assert drop_columns(df, ["b.c"]).columns == ["a", "d"]
    assert drop_columns(df, ["zz"], missing_ok=True).columns == ["a", "b.c", "d"]
    with pytest.raises(MissingColumnError):
        drop_columns(df, ["zz"])
    assert select_columns(df, ["d", "b.c"]).columns == ["d", "b.c"]


def test_profiled_columns_restrict_statistics_too(spark):
    df = spark.createDataFrame([(1, 2.0, "a")], "a int, b double, s string")
    for layout in ("wide", "long"):
        rep = quality_report(df, columns=["b", "s"], layout=layout).collect()
        subjects = {(r["check"], r["subject"]) for r in rep}
        assert ("describe", "b") in subjects and ("describe", "a") not in subjects
        assert ("completeness", "a") not in subjects


mixed_rows = st.lists(
    st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)),
              st.one_of(st.none(), st.sampled_from(["a", "b", "c"])), st.integers(0, 9)),
    min_size=1, max_size=25,
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(mixed_rows, st.booleans(), st.sampled_from([None, True, False]))
def test_mixed_order_with_null_placement_matches_python(spark, data, t_desc, nulls_first):
    """order_by = [t (asc/desc, nulls first/last/default), s asc]; ties on the
    remaining column follow the first key's direction."""
    df = spark.createDataFrame(data, "k int, t int, s string, v int")
    t_key = "t" + (" desc" if t_desc else "") + (
        "" if nulls_first is None else (" nulls first" if nulls_first else " nulls last"))
    got = {r["k"]: tuple(r) for r in keep_one(df, ["k"], [t_key, "s asc"]).collect()}

    t_nulls_first = (not t_desc) if nulls_first is None else nulls_first

    def key(row):
        _, t, s, v = row
        tk = (0 if t is None else 1) if t_nulls_first else (1 if t is None else 0)
        tv = 0 if t is None else (-t if t_desc else t)
        sk = (0, "") if s is None else (1, s)          # asc, nulls first
        vk = -v if t_desc else v                       # tie-break in t's direction
        return (tk, tv, sk, vk)

    want = {}
    for row in data:
        if row[0] not in want or key(row) < key(want[row[0]]):
            want[row[0]] = row
    assert got == {k: tuple(r) for k, r in want.items()}


typed_rows = st.lists(
    st.tuples(st.integers(0, 2),
              st.one_of(st.none(), st.integers(-3, 3)),
              st.one_of(st.none(), st.just(NAN), st.sampled_from([-1.5, 0.0, 2.5])),
              st.one_of(st.none(), st.sampled_from([dt.date(2020, 1, d) for d in (1, 2, 3)])),
              # beginnings of each other, bytes above ASCII, NUL, code points beyond 16 bits
              st.one_of(st.none(), st.sampled_from(["", "a", "ab", "a\0", "a\x7f", "aé", "ﬀ", "😀", "G"])),
              st.one_of(st.none(), st.booleans()),
              st.integers(0, 50)),
    min_size=1, max_size=25,
)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(typed_rows, st.lists(st.tuples(st.sampled_from(["i", "d", "dt", "s", "b", "y"]), st.booleans(),
                                      st.sampled_from([None, True, False])),
                            min_size=1, max_size=4, unique_by=lambda x: x[0]))
def test_aggregate_strategy_handles_any_order(spark, data, keys):
    """Mixed directions / NULL placement on numbers (NaN too), dates, text, bytes and booleans:
    the aggregate strategy picks exactly the window strategy's survivor."""
    df = spark.createDataFrame(data, "k int, i int, d double, dt date, s string, b boolean, v int") \
        .selectExpr("*", "encode(s, 'utf-16') as y")
    order = [c + (" desc" if desc else "") +
             ("" if nf is None else (" nulls first" if nf else " nulls last"))
             for c, desc, nf in keys]
    agg = keep_one(df, ["k"], order, strategy="aggregate", count_col="n")
    win = keep_one(df, ["k"], order, strategy="window")
    def norm(row):
        return tuple("NaN" if isinstance(x, float) and math.isnan(x) else x for x in row)

    a = sorted((norm(r[:8]) for r in agg.collect()), key=repr)
    w = sorted((norm(r) for r in win.collect()), key=repr)
    assert a == w
    assert sum(r["n"] for r in agg.collect()) == len(data)


def test_column_names_follow_the_session_case_rule(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (1, 3.0, "y")], "ID int, Value double, `odd.Name` string")
    assert [tuple(r) for r in keep_one(df, ["id"], ["VALUE desc"], count_col="n").collect()] == [(1, 3.0, "y", 2)]
    assert keep_one(df, ["id"], ["value desc"], strategy="window").first()["odd.Name"] == "y"
    assert duplicate_metrics(df, ["id"]).first()["n_unique"] == 1
    assert range_check(df, [{"column": "value", "min": 0, "max": 2.5}]).first()["n_invalid"] == 1
    assert {r["column"] for r in completeness(df, ["id", "odd.name"]).collect()} == {"id", "odd.name"}
    assert describe_numeric(df, ["VALUE"]).first()["max"] == 3.0
    rep = {(r["check"], r["subject"]) for r in quality_report(df, ["id"], columns=["value"]).collect()}
    assert ("describe", "value") in rep and ("duplicates", "id") in rep
    exact = spark.newSession()
    exact.conf.set("spark.sql.caseSensitive", "true")
    with pytest.raises(MissingColumnError):
        keep_one(exact.createDataFrame([(1,)], "ID int"), ["id"])
