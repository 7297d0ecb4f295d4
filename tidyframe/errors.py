"""Exceptions raised by the library before any Spark job starts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


class SpecError(ValueError):
    """A job/source/sink spec is malformed (unknown key, format, mode...)."""


class MissingColumnError(ValueError):
    """An operator was asked to work on a column the DataFrame lacks."""


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    """Fail fast, with every missing name, instead of a late AnalysisException.  Names
    are compared under the session's case rule, as Spark resolves them."""
    present = set(df.columns)
    missing = [c for c in columns if c not in present]
    if missing and df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() != "true":
        lower = {c.lower() for c in present}
        missing = [c for c in missing if c.lower() not in lower]
    if missing:
        raise MissingColumnError(
            f"column(s) {missing} not found; available: {sorted(present)}"
        )
