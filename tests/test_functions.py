"""Column functions on tiny in-code frames with the edge rows of FIXTURES §5."""

from __future__ import annotations

import datetime as dt
import unicodedata

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidyframe.errors import MissingColumnError, SpecError
from tidyframe.functions import (
    accent_table,
    add_run_stamps,
    age_years,
    cast_column,
    cast_columns,
    check_date_pattern,
    normalize_text,
    nulled_by,
    parse_date,
    reformat_date,
    split_column,
    split_pair,
    squish,
    strip_accents,
    title_case,
    title_case_plain,
)


def one_col(spark, values, name="s", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")


def col_values(df, name):
    return [r[0] for r in df.select(name).collect()]


# ------------------------------------------------------------------------ text


def test_normalize_text_whitespace_and_case(spark):
    df = one_col(spark, ["  Ana \t  Maria ", "Ana\u00a0Maria", "\tJOÃO\n", "", None, "a   b"])
    out = col_values(df.select(normalize_text("s").alias("s")), "s")
    assert out == ["ana maria", "ana maria", "joão", "", None, "a b"]


def test_ascii_whitespace_mode_keeps_nbsp(spark):
    df = one_col(spark, ["Ana\u00a0 Maria"])
    assert col_values(df.select(squish("s", unicode=False).alias("s")), "s") == ["Ana\u00a0 Maria"]


def test_title_case_space_delimited(spark):
    df = one_col(spark, ["maria d'ávila silva-souza", "  JOSÉ   da  SILVA "])
    out = col_values(df.select(title_case("s").alias("s")), "s")
    assert out == ["Maria D'ávila Silva-souza", "José Da Silva"]


def test_strip_accents_extended_table(spark):
    df = one_col(spark, ["Ñandú Zoë Çédille", "Crème brûlée à São Paulo", "Łódź ß æ", None])
    out = col_values(df.select(strip_accents("s").alias("s")), "s")
    # letters without a canonical decomposition (Ł, ß, æ) are kept, like NFD does
    assert out == ["Nandu Zoe Cedille", "Creme brulee a Sao Paulo", "Łodz ß æ", None]


def test_strip_accents_drops_free_combining_marks(spark):
    decomposed = unicodedata.normalize("NFD", "São José")
    df = one_col(spark, [decomposed])
    assert col_values(df.select(strip_accents("s").alias("s")), "s") == ["Sao Jose"]


def test_accent_table_rule():
    src, dst = accent_table()
    pairs = dict(zip(src, dst))
    for ch, base in pairs.items():
        assert unicodedata.normalize("NFD", ch)[0] == base
    # every Latin-1 letter with a canonical decomposition is present
    for code in range(0xC0, 0x100):
        if unicodedata.decomposition(chr(code)):
            assert chr(code) in pairs
    assert len(src) > len(dst)  # trailing combining marks are deleted


def test_title_case_plain(spark):
    df = one_col(spark, ["  maria   d'ávila  "])
    assert col_values(df.select(title_case_plain("s").alias("s")), "s") == ["Maria D'avila"]


# --------------------------------------------------------------------- casting


def test_bulk_cast_follows_the_session_case_rule(spark):
    df = spark.createDataFrame([("1", "2")], "Temp string, other string")
    assert dict(cast_columns(df, ["temp"], "int").dtypes) == {"Temp": "int", "other": "string"}


def test_age_of_bad_text_is_null(spark):
    df = one_col(spark, ["2000-01-10", "abc", "31/02/2000", None])
    out = col_values(df.select(age_years("s", "2024-01-10").alias("s")), "s")
    assert out == [24, None, None, None]


def test_cast_null_policy(spark):
    df = one_col(spark, ["36.5", "abc", "36,5", "", None, " 7 "])
    out = col_values(cast_column(df, "s", "double"), "s")
    assert out == [36.5, None, None, None, None, 7.0]


def test_cast_fail_policy_raises(spark):
    df = one_col(spark, ["1.0", "abc"])
    with pytest.raises(PySparkException):
        cast_column(df, "s", "double", on_error="fail").collect()
    # NULL input is not an error
    ok = one_col(spark, ["1.0", None])
    assert col_values(cast_column(ok, "s", "double", on_error="fail"), "s") == [1.0, None]


def test_cast_columns_missing(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    out = cast_columns(df, ["a", "b", "zz"], "double")
    assert out.dtypes == [("a", "double"), ("b", "double")]
    with pytest.raises(MissingColumnError):
        cast_columns(df, ["a", "zz"], "double", missing="fail")
    with pytest.raises(MissingColumnError):
        cast_column(df, "zz", "int")


def test_nulled_by_counts_lost_values(spark):
    df = one_col(spark, ["1", "x", None, "2"])
    out = df.select(F.col("s"), F.col("s").try_cast("int").alias("i"))
    assert out.agg(nulled_by("s", "i").alias("n")).first()["n"] == 1


# ----------------------------------------------------------------------- dates


def test_reformat_date_bad_rows_null(spark):
    df = one_col(spark, ["25/07/1936", "31/02/2000", "5/7/1936", "2020-01-05", None, "29/02/2000"])
    out = col_values(df.select(reformat_date("s", "dd/MM/yyyy", "yyyy-MM-dd").alias("s")), "s")
    assert out == ["1936-07-25", None, None, None, None, "2000-02-29"]


def test_reformat_date_fail_policy(spark):
    df = one_col(spark, ["31/02/2000"])
    with pytest.raises(PySparkException):
        df.select(reformat_date("s", "dd/MM/yyyy", "yyyy-MM-dd", on_error="fail")).collect()


def test_minute_pattern_rejected():
    with pytest.raises(SpecError):
        check_date_pattern("dd/mm/yyyy")
    assert check_date_pattern("yyyy-MM-dd HH:mm") == "yyyy-MM-dd HH:mm"
    assert check_date_pattern("dd 'de' MMMM") == "dd 'de' MMMM"


def test_age_calendar_vs_days365(spark):
    df = spark.createDataFrame(
        [("10/01/1964",), ("29/02/2000",), ("01/01/2024",), (None,)], "birth string"
    )
    cal = df.select(age_years("birth", dt.date(2024, 1, 1), "dd/MM/yyyy").alias("a"))
    legacy = df.select(age_years("birth", dt.date(2024, 1, 1), "dd/MM/yyyy", "days365").alias("a"))
    assert col_values(cal, "a") == [59, 23, 0, None]
    assert col_values(legacy, "a") == [60, 23, 0, None]
    leap = df.select(age_years("birth", "2023-02-28", "dd/MM/yyyy").alias("a"))
    assert col_values(leap, "a")[1] == 23


def test_years_between_two_columns(spark):
    df = spark.createDataFrame(
        [(dt.date(2000, 5, 1), dt.date(2010, 4, 30)), (dt.date(2000, 5, 1), dt.date(2010, 5, 1))],
        "s date, e date",
    )
    from tidyframe.functions import years_between

    assert col_values(df.select(years_between("s", "e").alias("y")), "y") == [9, 10]


def test_parse_date_default_iso(spark):
    df = one_col(spark, ["2024-02-29", "nope"])
    assert col_values(df.select(parse_date("s").alias("d")), "d") == [dt.date(2024, 2, 29), None]


# ----------------------------------------------------------------------- split


def test_split_missing_parts(spark):
    df = one_col(spark, ["120/80", "120", "120/", None], name="bp")
    out = split_pair(df, "bp", "sys", "dia", keep_source=False)
    assert out.columns == ["sys", "dia"]
    assert [tuple(r) for r in out.collect()] == [("120", "80"), ("120", None), ("120", ""), (None, None)]


def test_split_cast_and_regex(spark):
    df = one_col(spark, ["1.5|2", "x|3"], name="v")
    out = split_column(df, "v", ["a", "b"], "|", cast="double")
    assert [tuple(r) for r in out.collect()] == [(1.5, 2.0), (None, 3.0)]
    rx = split_column(one_col(spark, ["a1b22c"], name="v"), "v", ["x", "y", "z"], r"\d+", regex=True)
    assert [tuple(r) for r in rx.collect()] == [("a", "b", "c")]


def test_split_rejects_bad_targets(spark):
    df = one_col(spark, ["a/b"], name="v")
    with pytest.raises(SpecError):
        split_column(df, "v", [])
    with pytest.raises(SpecError):
        split_column(df, "v", ["a", "a"])


# ---------------------------------------------------------------------- stamps


def test_run_stamps_are_literals(spark):
    df = one_col(spark, ["x", "y"])
    ts = dt.datetime(2024, 1, 2, 3, 4, 5, 600000)
    out = add_run_stamps(df, dt.date(2024, 1, 2), ts, ts_type="timestamp_ntz")
    rows = out.collect()
    assert {r["processing_date"] for r in rows} == {dt.date(2024, 1, 2)}
    assert {r["processing_ts"] for r in rows} == {ts}
    assert dict(out.dtypes)["processing_ts"] == "timestamp_ntz"


def test_no_python_udf_in_plans(spark):
    df = one_col(spark, ["a"])
    out = df.select(
        normalize_text("s"), title_case_plain("s"), reformat_date("s", "dd/MM/yyyy", "yyyy-MM-dd")
    )
    from conftest import plan_text

    plan = plan_text(out)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_run_stamp_instant_ignores_session_time_zone(spark):
    import datetime as _dt

    key = "spark.sql.session.timeZone"
    old = spark.conf.get(key)
    spark.conf.set(key, "America/Sao_Paulo")
    try:
        df = one_col(spark, ["x"])
        ts = _dt.datetime(2024, 1, 1, 8, 0, 0)  # UTC
        out = add_run_stamps(df, ts.date(), ts).select(
            F.unix_seconds("processing_ts").alias("s"), "processing_date")
        row = out.first()
        assert row["s"] == int(_dt.datetime(2024, 1, 1, 8, tzinfo=_dt.timezone.utc).timestamp())
        aware = _dt.datetime(2024, 1, 1, 5, 0, tzinfo=_dt.timezone(_dt.timedelta(hours=-3)))
        again = add_run_stamps(df, ts.date(), aware).select(F.unix_seconds("processing_ts")).first()[0]
        assert again == row["s"]
        ntz = add_run_stamps(df, ts.date(), ts, ts_type="timestamp_ntz").first()["processing_ts"]
        assert ntz == ts
    finally:
        spark.conf.set(key, old)


def test_whitespace_class_equals_unicode_white_space(spark):
    """The explicit class matches exactly Java's (?U)\\s over the whole BMP."""
    from tidyframe.functions.text import UNICODE_SPACE

    # every BMP code point except surrogates, as a one-character string
    chars = spark.range(0, 0x10000).filter("id < 55296 or id > 57343").selectExpr(
        "id", "decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE') as c")
    ours = F.col("c").rlike("^" + UNICODE_SPACE + "$")
    java = F.col("c").rlike(r"^(?U)\s+$")
    assert chars.filter(ours != java).count() == 0
    assert chars.filter(ours).count() == 25  # Unicode White_Space in the BMP
