"""DataFrame -> DataFrame steps, for chaining with ``df.transform``::

    (df.transform(normalize_columns, ["name"], "title_plain")
       .transform(reformat_dates, "birth", "dd/MM/yyyy", "yyyy-MM-dd")
       .transform(cast_columns, ["temp", "height"], "double")
       .transform(add_years, "age", "birth", "2024-01-01", "yyyy-MM-dd"))
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidyframe.errors import SpecError, require_columns
from tidyframe.functions._util import is_temporal
from tidyframe.functions.dates import reformat_date, years_between
from tidyframe.functions.text import normalize_text, strip_accents, title_case, title_case_plain

_ISO_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")

_TEXT_STEPS = {
    "text": normalize_text,
    "title": title_case,
    "title_plain": title_case_plain,
    "accents": strip_accents,
}


def normalize_columns(df: DataFrame, columns: Sequence[str], how: str = "text") -> DataFrame:
    """Apply one text normalisation (``text``, ``title``, ``title_plain``,
    ``accents``) to several columns in one projection."""
    if how not in _TEXT_STEPS:
        raise SpecError(f"how must be one of {sorted(_TEXT_STEPS)}, got {how!r}")
    require_columns(df, columns)
    fn = _TEXT_STEPS[how]
    return df.withColumns({c: fn(c) for c in columns})


def reformat_dates(
    df: DataFrame, column: str, src_fmt: str, dst_fmt: str = "yyyy-MM-dd", on_error: str = "null"
) -> DataFrame:
    """Re-format the date text in ``column`` in place."""
    require_columns(df, [column])
    src = None if is_temporal(df, column) else src_fmt
    return df.withColumn(column, reformat_date(column, src, dst_fmt, on_error))


def add_years(
    df: DataFrame, out: str, start, end, fmt: str | None = None, method: str = "calendar"
) -> DataFrame:
    """Add ``out`` = whole years from ``start`` to ``end`` (see ``years_between``).

    A string that is not a ``YYYY-MM-DD`` literal must name a column."""
    names = [x for x in (start, end) if isinstance(x, str) and not _ISO_DATE.fullmatch(x)]
    require_columns(df, names)
    if names and all(is_temporal(df, n) for n in names):
        fmt = None  # typed dates: nothing to parse
    return df.withColumn(out, years_between(start, end, fmt, method))
