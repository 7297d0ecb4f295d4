"""Type conversion with an explicit malformed-data policy.

``on_error="null"``  -> ``try_cast``: bad text becomes NULL.
``on_error="fail"``  -> the job stops at the first bad value, whatever the
session's ANSI setting (``raise_error`` instead of relying on ANSI mode).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidyframe.errors import SpecError, require_columns
from tidyframe.functions._util import as_col, own_name

ON_ERROR = ("null", "fail")


def _check_policy(on_error: str) -> None:
    if on_error not in ON_ERROR:
        raise SpecError(f"on_error must be one of {ON_ERROR}, got {on_error!r}")


def safe_cast(c: Column | str, to: str | DataType, on_error: str = "null") -> Column:
    """Cast a column; see module doc for the policy."""
    _check_policy(on_error)
    src = as_col(c)
    out = src.try_cast(to)
    if on_error == "null":
        return out
    return F.when(
        src.isNotNull() & out.isNull(),
        F.raise_error(F.concat(F.lit("cannot cast value: "), src.cast("string"))),
    ).otherwise(out)


def cast_column(
    df: DataFrame, column: str, to: str | DataType, on_error: str = "null"
) -> DataFrame:
    """Replace one column by its cast; the column must exist."""
    require_columns(df, [column])
    return df.withColumn(column, safe_cast(column, to, on_error))


def cast_columns(
    df: DataFrame,
    columns: list[str],
    to: str | DataType = "double",
    on_error: str = "null",
    missing: str = "skip",
) -> DataFrame:
    """Cast many columns in one projection.

    ``missing="skip"`` ignores names the frame lacks (bulk conversion from a
    config list); ``missing="fail"`` raises.
    """
    if missing not in ("skip", "fail"):
        raise SpecError(f"missing must be 'skip' or 'fail', got {missing!r}")
    if missing == "fail":
        require_columns(df, columns)
    present = [c for c in dict.fromkeys(own_name(df, c) for c in columns) if c is not None]
    if not present:
        return df
    return df.withColumns({c: safe_cast(c, to, on_error) for c in present})


def nulled_by(src: Column | str, out: Column | str) -> Column:
    """Aggregate: how many values a conversion turned into NULL."""
    return F.count_if(as_col(src).isNotNull() & as_col(out).isNull())
