"""Column-level functions: each returns a ``Column`` or a new ``DataFrame``."""

from tidyframe.functions.casting import cast_column, cast_columns, nulled_by, safe_cast
from tidyframe.functions.dates import (
    age_years,
    check_date_pattern,
    parse_date,
    reformat_date,
    years_between,
)
from tidyframe.functions.frame import add_years, normalize_columns, reformat_dates
from tidyframe.functions.split import split_column, split_pair
from tidyframe.functions.stamps import add_run_stamps, run_clock
from tidyframe.functions.text import (
    accent_table,
    collapse_whitespace,
    normalize_text,
    squish,
    strip_accents,
    title_case,
    title_case_plain,
)

__all__ = [
    "accent_table",
    "add_run_stamps",
    "add_years",
    "age_years",
    "cast_column",
    "cast_columns",
    "check_date_pattern",
    "collapse_whitespace",
    "normalize_columns",
    "normalize_text",
    "nulled_by",
    "parse_date",
    "reformat_date",
    "reformat_dates",
    "run_clock",
    "safe_cast",
    "split_column",
    "split_pair",
    "squish",
    "strip_accents",
    "title_case",
    "title_case_plain",
    "years_between",
]
