"""Projection helpers with up-front column checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidyframe.errors import require_columns
from tidyframe.functions._util import col


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep only ``columns`` (in that order); every name must exist."""
    require_columns(df, columns)
    return df.select(*[col(c) for c in columns])


def drop_columns(df: DataFrame, columns: Sequence[str], missing_ok: bool = False) -> DataFrame:
    """Drop ``columns``; unknown names raise unless ``missing_ok``."""
    if not missing_ok:
        require_columns(df, columns)
    return df.drop(*columns)
