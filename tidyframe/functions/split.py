"""Split one text column into several (``"120/80"`` -> two columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidyframe.errors import SpecError, require_columns
from tidyframe.functions._util import col
from tidyframe.functions.casting import safe_cast


def literal_pattern(sep: str) -> str:
    """Java-regex that matches ``sep`` literally."""
    if "\\E" not in sep:
        return f"\\Q{sep}\\E"
    return "".join(ch if ch.isalnum() else "\\" + ch for ch in sep)


def split_column(
    df: DataFrame,
    column: str,
    into: list[str],
    pattern: str = "/",
    regex: bool = False,
    keep_source: bool = False,
    cast: str | DataType | None = None,
    on_error: str = "null",
) -> DataFrame:
    """Split ``column`` on ``pattern`` into the columns named ``into``.

    Missing parts become NULL (``"120"`` -> ``("120", NULL)``); an empty part
    stays ``""``; a NULL input gives all NULLs.  The split array is computed
    once and every target reads one element of it.
    """
    if not into:
        raise SpecError("split_column needs at least one target column")
    if len(set(into)) != len(into):
        raise SpecError(f"duplicate target names in {into}")
    require_columns(df, [column])
    pat = pattern if regex else literal_pattern(pattern)
    tmp = f"__split_{column}"
    parts = df.withColumn(tmp, F.split(col(column), pat))
    targets = {}
    for i, name in enumerate(into):
        part = F.get(col(tmp), i)
        targets[name] = safe_cast(part, cast, on_error) if cast is not None else part
    out = parts.withColumns(targets).drop(tmp)
    if not keep_source and column not in into:
        out = out.drop(column)
    return out


def split_pair(
    df: DataFrame,
    column: str,
    first: str,
    second: str,
    sep: str = "/",
    keep_source: bool = True,
    cast: str | DataType | None = None,
    on_error: str = "null",
) -> DataFrame:
    """Two-way split, e.g. blood pressure ``"120/80"`` -> systolic, diastolic."""
    return split_column(
        df, column, [first, second], sep, False, keep_source, cast, on_error
    )

