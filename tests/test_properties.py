"""Property tests: Spark expressions vs small, independent Python statements
of the same rules, on generated text (accents, every kind of whitespace,
free combining marks) and generated NULL/NaN patterns."""

from __future__ import annotations

import calendar
import datetime as dt
import math
import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidyframe.functions import normalize_text, split_column, strip_accents
from tidyframe.operators import completeness, range_check

# Unicode White_Space (the BMP part), written out as the rule's definition
WHITE_SPACE = ("\t\n\x0b\x0c\r \x85\xa0\u1680"
               + "".join(chr(c) for c in range(0x2000, 0x200B))
               + "\u2028\u2029\u202f\u205f\u3000")
LETTERS = "abcXYZáéíóúâêôãõçÁÉÍÓÚÇñÑüÜëöäßøŁđĳΆέΩйЁ'-."
MARKS = "\u0327\u0301\u0303"  # free combining cedilla, acute, tilde
text = st.text(alphabet=LETTERS + WHITE_SPACE + MARKS + "0123456789/", max_size=40)
texts = st.lists(st.one_of(st.none(), text), min_size=1, max_size=25)
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))


def _frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")


def _ws_ref(s: str) -> str:
    return re.sub("[" + re.escape(WHITE_SPACE) + "]+", " ", s).strip(" ").lower()


def _accent_ref(s: str) -> str:
    out = []
    for ch in s:
        nfd = unicodedata.normalize("NFD", ch)
        cp = ord(ch)
        in_blocks = (0xC0 <= cp <= 0x24F or 0x370 <= cp <= 0x4FF
                     or 0x1E00 <= cp <= 0x1FFF)
        if 0x300 <= cp <= 0x36F:
            continue  # free combining mark
        if in_blocks and len(nfd) > 1 and all(unicodedata.combining(m) for m in nfd[1:]):
            out.append(nfd[0])
        else:
            out.append(ch)
    return "".join(out)


@SETTINGS
@given(texts)
def test_normalize_text_matches_rule(spark, values):
    got = {r["i"]: r["t"] for r in _frame(spark, values).select(
        "i", normalize_text("s").alias("t")).collect()}
    for i, v in enumerate(values):
        assert got[i] == (None if v is None else _ws_ref(v))


@SETTINGS
@given(texts)
def test_strip_accents_matches_rule(spark, values):
    got = {r["i"]: r["t"] for r in _frame(spark, values).select(
        "i", strip_accents("s").alias("t")).collect()}
    for i, v in enumerate(values):
        assert got[i] == (None if v is None else _accent_ref(v))


@SETTINGS
@given(texts)
def test_split_matches_python(spark, values):
    out = split_column(_frame(spark, values), "s", ["a", "b", "c"], "/")
    got = {r["i"]: (r["a"], r["b"], r["c"]) for r in out.collect()}
    for i, v in enumerate(values):
        if v is None:
            assert got[i] == (None, None, None)
        else:
            parts = v.split("/")
            assert got[i] == tuple(parts[k] if k < len(parts) else None for k in range(3))


nums = st.lists(st.one_of(st.none(), st.just(math.nan),
                          st.floats(-1e6, 1e6, allow_nan=False)), min_size=0, max_size=40)


@SETTINGS
@given(nums, st.floats(-100, 0), st.floats(0, 100))
def test_completeness_and_range_match_counting(spark, values, lo, hi):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    c = completeness(df).first()
    n = len(values)
    missing = sum(1 for v in values if v is None or math.isnan(v))
    assert (c["total"], c["n_null"]) == (n, missing)
    r = range_check(df, [{"column": "x", "min": lo, "max": hi}]).first()
    nulls = sum(1 for v in values if v is None)
    bad = sum(1 for v in values if v is not None and (math.isnan(v) or v < lo or v > hi))
    assert (r["n_null"], r["n_invalid"], r["n_valid"]) == (nulls, bad, n - nulls - bad)
    assert abs(r["pct_valid"] + r["pct_invalid"] + (100.0 * nulls / n if n else 0.0)
               - (100.0 if n else 0.0)) < 1e-9


def test_white_space_constant_is_unicode_white_space():
    bmp = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    # Python's str.isspace adds the four information separators 0x1C-0x1F
    py = {ch for ch in bmp if ch.isspace()} - {"\x1c", "\x1d", "\x1e", "\x1f"}
    assert set(WHITE_SPACE) == py


def _completed_years(start, end) -> int:
    """Calendar rule: a month completes on the same day of month, or when both
    dates are month ends (29 Feb -> 28 Feb completes a year); years = months // 12."""

    def month_end(d):
        return d.day == calendar.monthrange(d.year, d.month)[1]

    months = (end.year - start.year) * 12 + (end.month - start.month)
    if end.day == start.day or (month_end(end) and month_end(start)):
        frac = 0.0
    else:
        frac = (end.day - start.day) / 31.0
    return math.floor((months + frac) / 12.0)


dates = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31))


@SETTINGS
@given(st.lists(st.tuples(dates, dates), min_size=1, max_size=30))
def test_years_between_matches_calendar_rule(spark, pairs):
    from tidyframe.functions import years_between

    df = spark.createDataFrame([(i, s, e) for i, (s, e) in enumerate(pairs)],
                               "i int, s date, e date")
    got = {r["i"]: r["y"] for r in df.select("i", years_between("s", "e").alias("y")).collect()}
    for i, (s, e) in enumerate(pairs):
        assert got[i] == _completed_years(s, e), (s, e)


frames = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(-5, 5)),
              st.one_of(st.none(), st.just(math.nan), st.floats(-1e3, 1e3, allow_nan=False)),
              st.one_of(st.none(), st.sampled_from(["x", "y"]))),
    min_size=0, max_size=30,
)


@SETTINGS
@given(frames, st.booleans())
def test_wide_and_long_layouts_agree(spark, rows, legacy):
    from tidyframe.operators import quality_report

    df = spark.createDataFrame(rows, "i int, d double, s string")
    rules = [{"column": "d", "min": -10.0, "max": 10.0}, {"column": "i", "min": 0, "max": 3}]

    def report(layout):
        out = quality_report(df, keys=["s"], rules=rules, legacy_null_valid=legacy,
                             layout=layout)
        return {(r["check"], r["subject"], r["metric"]): r["value"] for r in out.collect()}

    wide, long = report("wide"), report("long")
    assert set(wide) == set(long)
    for k, v in wide.items():
        w = long[k]
        if v is None or w is None:
            assert v is None and w is None, k
        elif math.isnan(v) or math.isnan(w):
            assert math.isnan(v) and math.isnan(w), k
        else:
            assert abs(v - w) <= 1e-9 * max(1.0, abs(v)), (k, v, w)


keyed = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)),
                           st.one_of(st.none(), st.sampled_from(["p", "q"])),
                           st.integers(0, 100)), min_size=0, max_size=40)


@SETTINGS
@given(keyed)
def test_dedupe_counts_are_consistent(spark, rows):
    from tidyframe.operators import dedupe_report, duplicate_metrics, keep_one

    df = spark.createDataFrame(rows, "a int, b string, v int")
    keys = ["a", "b"]
    n_keys = len({(a, b) for a, b, _ in rows})
    kept = keep_one(df, keys, ["v desc"], count_col="n").collect()
    assert len(kept) == n_keys and sum(r["n"] for r in kept) == len(rows)
    rep = dedupe_report(df, keys).first()
    assert (rep["rows_before"], rep["rows_after"]) == (len(rows), n_keys)
    dm = duplicate_metrics(df, keys).first()
    assert (dm["total"], dm["n_unique"], dm["n_duplicate"]) == (len(rows), n_keys,
                                                               len(rows) - n_keys)
    approx = duplicate_metrics(df, keys, approx=True).first()
    assert approx["total"] == len(rows) and approx["n_unique"] == n_keys  # small: exact
