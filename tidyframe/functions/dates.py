"""Date parsing, re-formatting and year differences (all built-in expressions)."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidyframe.errors import SpecError
from tidyframe.functions._util import as_col
from tidyframe.functions.casting import _check_policy

AGE_METHODS = ("calendar", "days365")

_QUOTED = re.compile(r"'[^']*'")


def check_date_pattern(fmt: str) -> str:
    """Reject a date-only pattern that uses ``m`` (minute-of-hour).

    ``dd/mm/yyyy`` is almost always a typo for ``dd/MM/yyyy``: Spark parses the
    middle field as minutes and silently returns January.
    """
    bare = _QUOTED.sub("", fmt)
    if "m" in bare and not re.search(r"[HhKk]", bare):
        raise SpecError(
            f"date pattern {fmt!r} uses 'm' (minute) without an hour field; "
            "month is 'M'"
        )
    return fmt


def _raise_if_lost(src: Column, out: Column, what: str) -> Column:
    return F.when(
        src.isNotNull() & out.isNull(),
        F.raise_error(F.concat(F.lit(f"cannot parse {what}: "), src.cast("string"))),
    ).otherwise(out)


def parse_date(c: Column | str, fmt: str | None = None, on_error: str = "null") -> Column:
    """String (or timestamp) -> DATE.  Bad text -> NULL or a job failure."""
    _check_policy(on_error)
    src = as_col(c)
    if fmt is None:
        out = src.try_cast("date")
    else:
        out = F.try_to_date(src, check_date_pattern(fmt))
    return out if on_error == "null" else _raise_if_lost(src, out, "date")


def reformat_date(
    c: Column | str, src_fmt: str | None, dst_fmt: str, on_error: str = "null"
) -> Column:
    """Date text in one pattern -> text in another (``dd/MM/yyyy`` -> ``yyyy-MM-dd``).
    ``src_fmt=None``: the input is a date/timestamp (or ISO text)."""
    return F.date_format(parse_date(c, src_fmt, on_error), dst_fmt)


def _as_date(v, fmt: str | None, on_error: str) -> Column:
    if isinstance(v, (dt.date, dt.datetime)):
        d = v.date() if isinstance(v, dt.datetime) else v
        return F.lit(d)
    if isinstance(v, str) and re.fullmatch(r"\d{4}-\d{2}-\d{2}", v):
        return F.lit(dt.date.fromisoformat(v))
    col = as_col(v)
    return parse_date(col, fmt, on_error)


def years_between(
    start, end, fmt: str | None = None, method: str = "calendar", on_error: str = "null"
) -> Column:
    """Whole years from ``start`` to ``end``.

    ``start``/``end``: column name, Column, ``date`` or ``'YYYY-MM-DD'`` literal.
    ``fmt`` parses string columns.  ``calendar`` counts completed years
    (``floor(months_between / 12)``: 1964-01-10 -> 2024-01-01 is 59, and a
    29 Feb birth completes a year on 28 Feb); ``days365`` is the legacy
    ``int(days / 365)`` rule, which over-counts near birthdays.  Text that is no
    date gives NULL, or fails the job with ``on_error="fail"``.
    """
    if method not in AGE_METHODS:
        raise SpecError(f"method must be one of {AGE_METHODS}, got {method!r}")
    s, e = _as_date(start, fmt, on_error), _as_date(end, fmt, on_error)
    if method == "calendar":
        return F.floor(F.months_between(e, s) / F.lit(12)).cast("int")
    return (F.datediff(e, s) / F.lit(365)).cast("int")


def age_years(birth, asof, fmt: str | None = None, method: str = "calendar",
              on_error: str = "null") -> Column:
    """Age on ``asof`` of someone born on ``birth`` (see ``years_between``)."""
    return years_between(birth, asof, fmt, method, on_error)
