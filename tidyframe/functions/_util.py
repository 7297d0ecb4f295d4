from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType


def col(name: str) -> Column:
    """Column by its exact name: dots, spaces and backticks are literal
    (``F.col("a.b")`` would read a field ``b`` of a struct ``a``)."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_col(c: Column | str) -> Column:
    return col(c) if isinstance(c, str) else c


def pct(part: Column, whole: Column) -> Column:
    """100 * part / whole as double; 0 when ``whole`` is 0 (empty input)."""
    return F.when(
        whole > 0, F.lit(100.0) * part.cast("double") / whole.cast("double")
    ).otherwise(F.lit(0.0))


def own_name(df: DataFrame, name: str) -> str | None:
    """``name`` as the frame spells it, by the session's case rule; None if absent."""
    if name in df.columns:
        return name
    if df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true":
        return None
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def type_of(df: DataFrame, name: str) -> DataType:
    """Type of the column that ``name`` means under the session's case rule."""
    return df.schema[own_name(df, name) or name].dataType


def is_temporal(df: DataFrame, name: str) -> bool:
    """Column already holds dates/timestamps (no text pattern applies)."""
    return isinstance(type_of(df, name), (DateType, TimestampType, TimestampNTZType))
