"""SQL text helpers for expressions built as one ``selectExpr`` string."""

from __future__ import annotations

import math


def quote_ident(name: str) -> str:
    """Column name as a SQL identifier (dots, spaces, backticks literal)."""
    return "`" + name.replace("`", "``") + "`"


def sql_str(text: str) -> str:
    """Python string as a Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_double(x: float) -> str:
    """Python float as a Spark SQL DOUBLE literal (incl. infinities, NaN)."""
    if math.isfinite(x):
        return f"{float(x)!r}D"
    word = "NaN" if math.isnan(x) else ("Infinity" if x > 0 else "-Infinity")
    return f"CAST('{word}' AS DOUBLE)"


def pct_sql(part: str, whole: str) -> str:
    """100 * part / whole in DOUBLE (0 for an empty whole), as in ``pct``."""
    return (f"CASE WHEN {whole} > 0 THEN 100.0D * CAST({part} AS DOUBLE) "
            f"/ CAST({whole} AS DOUBLE) ELSE 0.0D END")
