"""Quality metrics in a form that adds up: one row per column, range rule and key.

A report holds means and percentages, which cannot be combined.  A state holds counts, mean
and sum of squared deviations, extremes, out-of-range counts and a Theta sketch
of the keys: the states of many batches, runs or days merge into the report of all
their rows without reading the rows again.

* ``metric_state(df)`` is one aggregate, one scan, like ``quality_report``; a job observes
  the same expressions during its write (``quality.state_sink``).
* ``merge_states`` needs one small shuffle of state rows: counts add, means and
  squared deviations combine around the common mean (no cancellation), sketches unite.
* ``report_from_state`` gives the rows of ``quality_report``.  Distinct keys are exact up to
  ``2**SKETCH_LG`` keys, estimated beyond (relative error about ``2**(-SKETCH_LG/2)``);
  means and deviations differ from a single pass by the order of the sums only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyframe.errors import SpecError, require_columns
from tidyframe.functions._util import col
from tidyframe.operators._sql import pct_sql, sql_double, sql_str
from tidyframe.operators.quality import (
    MetricPlan,
    RangeRule,
    _describe_columns,
    _numeric_among,
    _rules,
    _unpivot,
    quality_plan,
)

SKETCH_LG = 16
COLUMN, RANGE, KEYS = "column", "range", "keys"
STATE_SCHEMA = (
    "kind string, subject string, lo double, hi double, total bigint, n_null bigint, n bigint, "
    "mean double, m2 double, min double, max double, n_bad bigint, n_unique bigint, sketch binary"
)
_FIELDS = [f.split()[0] for f in STATE_SCHEMA.split(", ")]
_TYPES = dict(f.split() for f in STATE_SCHEMA.split(", "))


def _state_row(**values: str) -> str:
    """One state row as SQL text over the one-row aggregate."""
    cells = (f"'{f}', CAST({values.get(f, 'NULL')} AS {_TYPES[f]})" for f in _FIELDS)
    return f"named_struct({', '.join(cells)})"


def _key_sketch(keys: Sequence[str], lg: int) -> Column:
    # as text, so that a NULL key is a value and ("a", NULL) differs from (NULL, "a")
    return F.theta_sketch_agg(F.to_json(F.struct(*[col(k) for k in keys]), {"ignoreNullFields": "false"}), lg)


def state_plan(
    df: DataFrame,
    rules: Sequence[RangeRule | dict] = (),
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = (),
    describe: bool = True,
    rows_before: str | None = None,
    lg: int = SKETCH_LG,
) -> MetricPlan:
    """The expressions of ``quality_plan`` plus a key sketch, shaped as state rows.
    ``rows_before``: name of an expression that counts the rows before a dedupe."""
    cols = list(columns) if columns is not None else list(df.columns)
    rules = _rules(df, rules)
    exprs = dict(quality_plan(df, rules, cols, describe).exprs)
    described = _describe_columns(df, _numeric_among(df, columns)) if describe else []
    entries = []
    for i, c in enumerate(cols):
        more = {}
        if c in described:
            k = described.index(c)
            more = {"n": f"__n_{k}", "mean": f"__mean_{k}", "min": f"__min_{k}", "max": f"__max_{k}",
                    # a single value has no deviation; none has no state
                    "m2": f"CASE WHEN __n_{k} = 1 THEN __mean_{k} - __mean_{k} "
                          f"ELSE __sd_{k} * __sd_{k} * (__n_{k} - 1) END"}
        entries.append(_state_row(kind=sql_str(COLUMN), subject=sql_str(c), total="__total",
                                  n_null=f"__null_{i}", **more))
    done = set()
    for i, r in enumerate(rules):
        if r not in done:
            entries.append(_state_row(
                kind=sql_str(RANGE), subject=sql_str(r.column), lo=sql_double(r.min), hi=sql_double(r.max),
                total="__total", n_null=f"__rnull_{i}", n_bad=f"__rbad_{i}"))
        done.add(r)
    if keys:
        require_columns(df, keys)
        exprs["__key_sketch"] = _key_sketch(keys, lg)
        entries.append(_state_row(
            kind=sql_str(KEYS), subject=sql_str(",".join(keys)), total=rows_before or "__total",
            n_unique="__total" if rows_before else "NULL", sketch="__key_sketch"))
    return MetricPlan(exprs, lambda wide: _unpivot(wide, [], entries, STATE_SCHEMA))


def metric_state(
    df: DataFrame,
    keys: Sequence[str] = (),
    rules: Sequence[RangeRule | dict] = (),
    columns: Sequence[str] | None = None,
    describe: bool = True,
    lg: int = SKETCH_LG,
) -> DataFrame:
    """State rows of ``df``: one aggregate over one scan."""
    return state_plan(df, rules, columns, keys, describe, lg=lg).run(df)


def merge_states(states: DataFrame, by: Sequence[str] = (), lg: int = SKETCH_LG) -> DataFrame:
    """One state per kind, subject and range (and per value of ``by``)."""
    require_columns(states, [*_FIELDS, *by])
    same = [*by, "kind", "subject", "lo", "hi"]
    group = [col(c) for c in same]
    every = Window.partitionBy(*group)
    n = F.coalesce(F.col("n"), F.lit(0))
    centre = F.sum(n * F.col("mean")).over(every) / F.nullif(F.sum(n).over(every), F.lit(0))
    off = F.col("mean") - F.col("__centre")
    merged = states.withColumn("__centre", centre).groupBy(*group).agg(
        *(F.sum(c).alias(c) for c in ("total", "n_null", "n")),
        F.first("__centre").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        *(F.sum(c).alias(c) for c in ("n_bad", "n_unique")),
        F.theta_union_agg("sketch", lg).alias("sketch"))
    sketch = F.when(F.col("kind") == KEYS, F.col("sketch"))
    return merged.select(*[col(c) for c in by], *[c for c in _FIELDS if c != "sketch"], sketch.alias("sketch"))


def report_from_state(
    states: DataFrame, by: Sequence[str] = (), legacy_null_valid: bool = False, lg: int = SKETCH_LG
) -> DataFrame:
    """Report rows ``(*by, check, subject, metric, value)`` of all rows the states cover.

    A key's ``total`` is the number of rows before a job's dedupe where there was one."""
    if set(by) & {"check", "subject", "metric", "value"}:
        raise SpecError("by names a report column")
    merged = merge_states(states, by, lg).withColumn(
        "n_unique", F.least(F.col("total"), F.when(F.col("sketch").isNotNull(),
                                                   F.theta_sketch_estimate("sketch"))))

    def e(check: str, metric: str, value: str) -> str:
        return (f"named_struct('check', '{check}', 'subject', subject, "
                f"'metric', '{metric}', 'value', CAST({value} AS DOUBLE))")

    def part(check: str, **metrics: str) -> str:
        return f"array({', '.join(e(check, m, v) for m, v in metrics.items())})"

    comp = part("completeness", total="total", n_null="n_null", n_filled="(total - n_null)",
                pct_null=pct_sql("n_null", "total"), pct_filled=pct_sql("(total - n_null)", "total"))
    desc = part("describe", count="n", mean="mean", stddev="CASE WHEN n > 1 THEN sqrt(m2 / (n - 1)) END",
                min="min", max="max")
    valid = "(total - n_bad)" if legacy_null_valid else "(total - n_bad - n_null)"
    rng = part("range", total="total", n_valid=valid, n_invalid="n_bad", n_null="n_null",
               pct_invalid=pct_sql("n_bad", "total"), pct_valid=pct_sql(valid, "total"))
    dup = part("duplicates", total="total", n_unique="n_unique", n_duplicate="(total - n_unique)",
               pct_duplicate=pct_sql("(total - n_unique)", "total"))
    return merged.selectExpr(
        *[f"`{c}`" for c in by],
        f"inline(CASE WHEN kind = '{RANGE}' THEN {rng} WHEN kind = '{KEYS}' THEN {dup} "
        f"WHEN n IS NULL THEN {comp} ELSE concat({comp}, {desc}) END)")
