"""Processing-date / processing-timestamp columns.

The values are fixed once per run on the driver and injected as literals, so
every row, every retried task and every later action sees the same stamp
(``current_date()`` would be re-evaluated per action).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_clock(now: dt.datetime | None = None) -> tuple[dt.date, dt.datetime]:
    """(run date, run timestamp) taken once, in UTC, at millisecond precision
    (what text sinks such as CSV / JSON keep by default)."""
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    now = now.replace(microsecond=now.microsecond // 1000 * 1000)
    return now.date(), now


def add_run_stamps(
    df: DataFrame,
    run_date: dt.date,
    run_ts: dt.datetime | None = None,
    date_col: str | None = "processing_date",
    ts_col: str | None = "processing_ts",
    ts_type: str = "timestamp",
) -> DataFrame:
    """Append the run's date and timestamp as constant columns.

    ``ts_type`` is ``timestamp`` (the run's instant) or ``timestamp_ntz`` (its
    UTC wall clock); see ``ts_literal``.
    """
    cols = {}
    if date_col:
        cols[date_col] = date_literal(run_date)
    if ts_col:
        if run_ts is None:
            run_ts = dt.datetime.combine(run_date, dt.time())
        cols[ts_col] = ts_literal(run_ts, ts_type)
    return df.withColumns(cols) if cols else df


def date_literal(d: dt.date) -> Column:
    return F.lit(d.isoformat()).cast("date")


def ts_literal(ts: dt.datetime, ts_type: str = "timestamp") -> Column:
    """Run timestamps are UTC (naive = UTC; aware ones are converted).

    ``timestamp``: the exact instant, whatever the session or Python process
    time zone (ISO text with ``Z``).  ``timestamp_ntz``: the UTC wall clock.
    """
    if ts.tzinfo is not None:
        ts = ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
    text = ts.strftime("%Y-%m-%dT%H:%M:%S.%f")
    if ts_type == "timestamp":
        return F.lit(text + "Z").cast("timestamp")
    return F.lit(text).cast(ts_type)


def run_rows(
    date_col: str | None, ts_col: str, run_date: dt.date, run_ts: dt.datetime,
    ts_type: str = "timestamp",
) -> Column:
    """Condition selecting the rows a run stamped, as read back from any sink:
    the run timestamp's millisecond (text formats drop microseconds), plus the
    run date (which prunes date partitions)."""
    from tidyframe.functions._util import col

    if run_ts.tzinfo is not None:
        run_ts = run_ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
    start = run_ts.replace(microsecond=run_ts.microsecond // 1000 * 1000)
    end = start + dt.timedelta(milliseconds=1)
    ts = col(ts_col)
    cond = (ts >= ts_literal(start, ts_type)) & (ts < ts_literal(end, ts_type))
    if date_col:
        cond = cond & (col(date_col) == date_literal(run_date))
    return cond
