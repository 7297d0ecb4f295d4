"""Data-quality metrics as DataFrames.

Every check is a ``MetricPlan``: a flat list of aggregate expressions plus a
``shape`` step that turns the one-row result into the report rows.  That
split gives two ways to run the same check:

* standalone: ``plan.run(df)`` -> ``shape(df.agg(*aggs))``: ONE scan and one
  tiny final exchange whatever the number of columns or rules (a loop of
  ``filter().count()`` per column would be one job each);
* piggy-backed: ``df.observe(obs, *plan.aggs)`` while the data is written, and
  ``plan.from_row(spark, obs.get)`` afterwards -- no extra pass at all.

Only the exact duplicate check needs a shuffle (``groupBy(key)``), with
map-side pre-aggregation so a hot key costs one row per map task; its
HyperLogLog++ estimate (``approx``) joins the single aggregate instead.

Report rows are produced from the one-row aggregate by ONE ``selectExpr``
(``inline(array(named_struct(...)))``), not by a union of projections, which
would re-run the aggregate -- and the scan -- once per check.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    FloatType,
    NumericType,
    StructType,
)

from tidyframe.errors import SpecError, require_columns
from tidyframe.functions._util import col, pct, type_of
from tidyframe.operators._sql import pct_sql, sql_double, sql_str
from tidyframe.operators.quality_long import RANGE, long_aggregate

STATUS_OK, STATUS_WARN, STATUS_FAIL = "ok", "warn", "fail"


# --------------------------------------------------------------------------- plan


@dataclass
class MetricPlan:
    exprs: dict[str, Column]  # output name -> aggregate expression
    shape: Callable[[DataFrame], DataFrame]
    # (check, subject, metric, value) rows over the one-row aggregate, as SQL
    long: Callable[[], list[str]] | None = field(default=None)
    wide_schema: StructType | None = field(default=None)

    @property
    def aggs(self) -> list[Column]:
        return [e.alias(n) for n, e in self.exprs.items()]

    def run(self, df: DataFrame) -> DataFrame:
        return self.shape(df.agg(*self.aggs))

    def bind_schema(self, df: DataFrame) -> MetricPlan:
        """Resolve the one-row schema (analysis only, no job)."""
        self.wide_schema = df.agg(*self.aggs).schema
        return self

    def from_row(self, spark: SparkSession, values: dict) -> DataFrame:
        """Report from observed values (``Observation.get``)."""
        if self.wide_schema is None:
            raise SpecError("call bind_schema(df) before from_row")
        row = tuple(values.get(f.name) for f in self.wide_schema.fields)
        return self.shape(spark.createDataFrame([row], self.wide_schema))


def _entry(check: str, subject: str, metric: str, value_sql: str) -> str:
    """One report row as SQL text over the one-row aggregate.  The whole
    report is then ONE ``selectExpr`` call instead of thousands of Column
    round trips between Python and the JVM."""
    return (f"named_struct('check', {sql_str(check)}, 'subject', {sql_str(subject)}, "
            f"'metric', {sql_str(metric)}, 'value', CAST({value_sql} AS DOUBLE))")


def _unpivot(
    wide: DataFrame, keep: list[str], entries: list[str], empty_schema: str | None = None
) -> DataFrame:
    """One row -> one row per entry, without a shuffle: ``inline(array(...))``,
    built as ONE SQL expression (one call, however many columns)."""
    if not entries:
        return wide.sparkSession.createDataFrame([], empty_schema or REPORT_SCHEMA)
    return wide.selectExpr(*keep, f"inline(array({', '.join(entries)}))")


LAYOUTS = ("wide", "long")


def use_long_layout(layout: str) -> bool:
    """``wide``: one aggregate per metric and column, best for tens of columns; ``long``:
    unpivot once, fixed aggregates per column, best for hundreds (measured: 11 columns
    favour wide 2:1, 50 and more with statistics favour long 2-5:1).  The caller chooses."""
    if layout not in LAYOUTS:
        raise SpecError(f"layout must be one of {LAYOUTS}, got {layout!r}")
    return layout == "long"


def _report_from_long(agg: DataFrame, legacy_null_valid: bool) -> DataFrame:
    """Report rows from ``long_aggregate`` rows, in one projection."""

    def e(check: str, metric: str, value: str) -> str:
        return (f"named_struct('check', '{check}', 'subject', subject, "
                f"'metric', '{metric}', 'value', CAST({value} AS DOUBLE))")

    comp = [e("completeness", "total", "total"), e("completeness", "n_null", "n_miss"),
            e("completeness", "n_filled", "(total - n_miss)"),
            e("completeness", "pct_null", pct_sql("n_miss", "total")),
            e("completeness", "pct_filled", pct_sql("(total - n_miss)", "total"))]
    desc = [e("describe", "count", "n"), e("describe", "mean", "mean"),
            e("describe", "stddev", "sd"), e("describe", "min", "mn"), e("describe", "max", "mx")]
    valid = "(total - n_bad)" if legacy_null_valid else "(total - n_bad - n_null)"
    rng = [e("range", "total", "total"), e("range", "n_valid", valid),
           e("range", "n_invalid", "n_bad"), e("range", "n_null", "n_null"),
           e("range", "pct_invalid", pct_sql("n_bad", "total")),
           e("range", "pct_valid", pct_sql(valid, "total"))]
    comp_a, desc_a, rng_a = (f"array({', '.join(x)})" for x in (comp, desc, rng))
    return agg.selectExpr(
        f"inline(CASE WHEN k = {RANGE} THEN {rng_a} "
        f"WHEN has_comp AND has_desc THEN concat({comp_a}, {desc_a}) "
        f"WHEN has_desc THEN {desc_a} ELSE {comp_a} END)"
    )


def _is_fractional(dtype) -> bool:
    return isinstance(dtype, (FloatType, DoubleType))


def _missing(df: DataFrame, name: str) -> Column:
    c = col(name)
    if _is_fractional(type_of(df, name)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _numeric_among(df: DataFrame, columns: Sequence[str] | None) -> list[str] | None:
    """Statistics cover the numeric columns among those profiled (all if None)."""
    if columns is None:
        return None
    return [c for c in columns if isinstance(type_of(df, c), NumericType)]


# ------------------------------------------------------------------ completeness


def completeness_plan(
    df: DataFrame, columns: Sequence[str] | None = None, warn_pct: float = 10.0
) -> MetricPlan:
    cols = list(columns) if columns is not None else list(df.columns)
    require_columns(df, cols)
    exprs = {"__total": F.count(F.lit(1))}
    exprs.update({f"__null_{i}": F.count_if(_missing(df, c)) for i, c in enumerate(cols)})

    def shape(wide: DataFrame) -> DataFrame:
        entries = [
            f"named_struct('column', {sql_str(c)}, 'n_null', __null_{i})"
            for i, c in enumerate(cols)
        ]
        long = _unpivot(wide, ["__total AS total"], entries,
                        "total bigint, column string, n_null bigint")
        return _completeness_finish(long, warn_pct)

    def long() -> list[str]:
        total, out = "__total", []
        for i, c in enumerate(cols):
            n = f"__null_{i}"
            out += [
                _entry("completeness", c, "total", total),
                _entry("completeness", c, "n_null", n),
                _entry("completeness", c, "n_filled", f"({total} - {n})"),
                _entry("completeness", c, "pct_null", pct_sql(n, total)),
                _entry("completeness", c, "pct_filled", pct_sql(f"({total} - {n})", total)),
            ]
        return out

    return MetricPlan(exprs, shape, long)


def _completeness_finish(long: DataFrame, warn_pct: float) -> DataFrame:
    """(column, total, n_null) -> the completeness report columns."""
    total, n_null = F.col("total"), F.col("n_null")
    p_null = pct(n_null, total)
    return long.select(
        "column",
        total.cast("bigint").alias("total"),
        n_null.cast("bigint").alias("n_null"),
        (total - n_null).cast("bigint").alias("n_filled"),
        p_null.alias("pct_null"),
        pct(total - n_null, total).alias("pct_filled"),
        F.when(n_null == 0, F.lit(STATUS_OK))
        .when(p_null < F.lit(float(warn_pct)), F.lit(STATUS_WARN))
        .otherwise(F.lit(STATUS_FAIL))
        .alias("status"),
    )


def completeness(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    warn_pct: float = 10.0,
    layout: str = "wide",
) -> DataFrame:
    """Per column: total, n_null, n_filled, pct_null, pct_filled, status.

    NULL counts as missing everywhere; NaN too for float/double columns.
    ``status``: ``ok`` with no missing value, ``warn`` below ``warn_pct`` %,
    else ``fail``.  Empty input gives 0 % (no division error).  ``layout``:
    see ``use_long_layout`` (same results either way).
    """
    cols = list(columns) if columns is not None else list(df.columns)
    require_columns(df, cols)
    if not use_long_layout(layout):
        return completeness_plan(df, cols, warn_pct).run(df)
    agg = long_aggregate(df, comp_cols=cols)
    return _completeness_finish(
        agg.select(F.col("subject").alias("column"), "total", F.col("n_miss").alias("n_null")),
        warn_pct,
    )


# ------------------------------------------------------------------- statistics


def _describe_columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    cols = list(columns) if columns is not None else numeric_columns(df)
    require_columns(df, cols)
    for c in cols:
        if not isinstance(type_of(df, c), NumericType):
            raise SpecError(f"describe needs numeric columns; {c!r} is not")
    return cols


def describe_plan(df: DataFrame, columns: Sequence[str] | None = None) -> MetricPlan:
    cols = _describe_columns(df, columns)
    exprs = {}
    for i, c in enumerate(cols):
        x = col(c)
        if isinstance(type_of(df, c), DecimalType):
            x = x.cast("double")
        exprs[f"__n_{i}"] = F.count(x)
        exprs[f"__mean_{i}"] = F.avg(x).cast("double")
        exprs[f"__sd_{i}"] = F.stddev_samp(x).cast("double")
        exprs[f"__min_{i}"] = F.min(x).cast("double")
        exprs[f"__max_{i}"] = F.max(x).cast("double")

    def shape(wide: DataFrame) -> DataFrame:
        entries = [
            f"named_struct('column', {sql_str(c)}, 'count', CAST(__n_{i} AS BIGINT), "
            f"'mean', __mean_{i}, 'stddev', __sd_{i}, 'min', __min_{i}, 'max', __max_{i})"
            for i, c in enumerate(cols)
        ]
        if not entries:
            return wide.sparkSession.createDataFrame(
                [], "column string, count bigint, mean double, stddev double, "
                "min double, max double"
            )
        return _unpivot(wide, [], entries)

    def long() -> list[str]:
        out = []
        for i, c in enumerate(cols):
            for metric, prefix in (("count", "__n"), ("mean", "__mean"), ("stddev", "__sd"),
                                   ("min", "__min"), ("max", "__max")):
                out.append(_entry("describe", c, metric, f"{prefix}_{i}"))
        return out

    return MetricPlan(exprs, shape, long)


def describe_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, layout: str = "wide"
) -> DataFrame:
    """Per numeric column: count (non-null), mean, stddev (sample), min, max."""
    cols = _describe_columns(df, columns)
    if not use_long_layout(layout):
        return describe_plan(df, cols).run(df)
    return long_aggregate(df, desc_cols=cols).select(
        F.col("subject").alias("column"), F.col("n").alias("count"), "mean",
        F.col("sd").alias("stddev"), F.col("mn").alias("min"), F.col("mx").alias("max"))


# ------------------------------------------------------------------------ ranges


@dataclass(frozen=True)
class RangeRule:
    """Valid when ``min <= value <= max`` (both bounds inclusive)."""

    column: str
    min: float
    max: float

    @classmethod
    def from_dict(cls, d: dict) -> RangeRule:
        unknown = set(d) - {"column", "min", "max"}
        if unknown or not {"column", "min", "max"} <= set(d):
            raise SpecError(f"range rule needs exactly column/min/max, got {sorted(d)}")
        if float(d["min"]) > float(d["max"]):
            raise SpecError(f"range rule for {d['column']!r}: min > max")
        return cls(str(d["column"]), float(d["min"]), float(d["max"]))


def range_plan(
    df: DataFrame, rules: Sequence[RangeRule | dict], legacy_null_valid: bool = False
) -> MetricPlan:
    rules = [r if isinstance(r, RangeRule) else RangeRule.from_dict(r) for r in rules]
    require_columns(df, [r.column for r in rules])
    exprs = {"__total": F.count(F.lit(1))}
    for i, r in enumerate(rules):
        x = col(r.column)
        exprs[f"__rnull_{i}"] = F.count_if(x.isNull())
        # NaN sorts above every number in Spark, so it lands in "invalid".
        exprs[f"__rbad_{i}"] = F.count_if((x < F.lit(r.min)) | (x > F.lit(r.max)))

    def shape(wide: DataFrame) -> DataFrame:
        entries = [
            f"named_struct('column', {sql_str(r.column)}, 'min', {sql_double(r.min)}, "
            f"'max', {sql_double(r.max)}, 'n_null', __rnull_{i}, 'n_invalid', __rbad_{i})"
            for i, r in enumerate(rules)
        ]
        if not entries:
            return wide.sparkSession.createDataFrame(
                [], "column string, min double, max double, total bigint, "
                "n_valid bigint, n_invalid bigint, n_null bigint, "
                "pct_invalid double, pct_valid double"
            )
        long = _unpivot(wide, ["__total AS total"], entries)
        return _range_finish(long, legacy_null_valid)

    def long() -> list[str]:
        total, out = "__total", []
        for i, r in enumerate(rules):
            n_null, bad = f"__rnull_{i}", f"__rbad_{i}"
            valid = f"({total} - {bad})" if legacy_null_valid else f"({total} - {bad} - {n_null})"
            c = r.column
            out += [
                _entry("range", c, "total", total),
                _entry("range", c, "n_valid", valid),
                _entry("range", c, "n_invalid", bad),
                _entry("range", c, "n_null", n_null),
                _entry("range", c, "pct_invalid", pct_sql(bad, total)),
                _entry("range", c, "pct_valid", pct_sql(valid, total)),
            ]
        return out

    return MetricPlan(exprs, shape, long)


def _range_finish(long: DataFrame, legacy_null_valid: bool) -> DataFrame:
    """(column, min, max, total, n_null, n_invalid) -> the range report columns."""
    total, n_null, bad = F.col("total"), F.col("n_null"), F.col("n_invalid")
    valid = total - bad if legacy_null_valid else total - bad - n_null
    return long.select(
        "column",
        "min",
        "max",
        total.cast("bigint").alias("total"),
        valid.cast("bigint").alias("n_valid"),
        bad.cast("bigint").alias("n_invalid"),
        n_null.cast("bigint").alias("n_null"),
        pct(bad, total).alias("pct_invalid"),
        pct(valid, total).alias("pct_valid"),
    )


def _rules(df: DataFrame, rules: Sequence[RangeRule | dict]) -> list[RangeRule]:
    out = [r if isinstance(r, RangeRule) else RangeRule.from_dict(r) for r in rules]
    require_columns(df, [r.column for r in out])
    return out


def range_check(
    df: DataFrame,
    rules: Sequence[RangeRule | dict],
    legacy_null_valid: bool = False,
    layout: str = "wide",
) -> DataFrame:
    """One row per rule: total, n_valid, n_invalid, n_null, pct_invalid, pct_valid.

    NULLs are counted apart (neither valid nor invalid); NaN is invalid.
    ``legacy_null_valid=True`` counts NULLs as valid, like a plain
    ``filter(out of range).count()`` does.
    """
    rules = _rules(df, rules)
    if not use_long_layout(layout):
        return range_plan(df, rules, legacy_null_valid).run(df)
    agg = long_aggregate(df, rules=rules)
    return _range_finish(
        agg.select(F.col("subject").alias("column"), F.col("lo").alias("min"),
                   F.col("hi").alias("max"), "total", "n_null",
                   F.col("n_bad").alias("n_invalid")),
        legacy_null_valid,
    )


# -------------------------------------------------------------------- duplicates


def _approx_unique(keys: Sequence[str], rsd: float) -> Column:
    # struct(...) is never NULL, so a NULL key counts as one value, as in the
    # exact path; HyperLogLog++ sketches merge without shuffling the keys
    return F.approx_count_distinct(F.struct(*[col(k) for k in keys]), rsd)


def duplicate_metrics(
    df: DataFrame, keys: Sequence[str], approx: bool = False, rsd: float = 0.01
) -> DataFrame:
    """One row: key, total, n_unique, n_duplicate, pct_duplicate.

    A NULL key is one distinct value (like ``distinct()``, unlike
    ``count(distinct)`` which skips NULLs).  Exact by default: one shuffle of
    the keys, pre-aggregated per map task.  ``approx=True`` estimates
    ``n_unique`` with HyperLogLog++ (relative std. error ``rsd``) in one pass
    with no key shuffle -- for very high-cardinality keys at scale.
    """
    keys = list(keys)
    if not keys:
        raise SpecError("duplicate_metrics needs a key")
    require_columns(df, keys)
    if approx:
        one = df.agg(F.count(F.lit(1)).alias("__total"),
                     _approx_unique(keys, rsd).alias("__unique"))
        return duplicates_shape(one, keys)
    per_key = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    one = per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("__total"),
        F.count(F.lit(1)).alias("__unique"),
    )
    return duplicates_shape(one, keys)


def duplicates_shape(one: DataFrame, keys: Sequence[str]) -> DataFrame:
    total = F.col("__total")
    uniq = F.least(F.col("__unique"), total)  # an estimate never exceeds the rows
    return one.select(
        F.lit(",".join(keys)).alias("key"),
        total.cast("bigint").alias("total"),
        uniq.cast("bigint").alias("n_unique"),
        (total - uniq).cast("bigint").alias("n_duplicate"),
        pct(total - uniq, total).alias("pct_duplicate"),
    )


# ------------------------------------------------------------------ full report

REPORT_SCHEMA = "check string, subject string, metric string, value double"


def _long(df: DataFrame, check: str, subject: str, metrics: list[str]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(check).alias("check"),
            F.col(subject).cast("string").alias("subject"),
            F.lit(m).alias("metric"),
            F.col(m).cast("double").alias("value"),
        )
        for m in metrics
    ]
    return df.select(F.inline(F.array(*entries)))


def report_from_parts(
    completeness_df: DataFrame | None,
    duplicates_df: DataFrame | None,
    describe_df: DataFrame | None,
    range_df: DataFrame | None,
) -> DataFrame:
    parts = []
    if completeness_df is not None:
        parts.append(
            _long(completeness_df, "completeness", "column",
                  ["total", "n_null", "n_filled", "pct_null", "pct_filled"])
        )
    if duplicates_df is not None:
        parts.append(
            _long(duplicates_df, "duplicates", "key",
                  ["total", "n_unique", "n_duplicate", "pct_duplicate"])
        )
    if describe_df is not None:
        parts.append(
            _long(describe_df, "describe", "column", ["count", "mean", "stddev", "min", "max"])
        )
    if range_df is not None:
        parts.append(
            _long(range_df, "range", "column",
                  ["total", "n_valid", "n_invalid", "n_null", "pct_invalid", "pct_valid"])
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_plan(
    df: DataFrame,
    rules: Sequence[RangeRule | dict] = (),
    columns: Sequence[str] | None = None,
    describe: bool = True,
    warn_pct: float = 10.0,
    legacy_null_valid: bool = False,
    approx_keys: Sequence[str] | None = None,
    rsd: float = 0.01,
) -> MetricPlan:
    """Completeness + statistics + ranges fused into ONE aggregate (one scan).

    ``approx_keys`` adds an estimated duplicate check (HyperLogLog++) to the
    same aggregate, so the whole report stays one pass without a shuffle.
    """
    comp = completeness_plan(df, columns, warn_pct)
    desc = describe_plan(df, _numeric_among(df, columns)) if describe else None
    rng = range_plan(df, rules, legacy_null_valid) if rules else None
    exprs = dict(comp.exprs)  # "__total" is shared by name
    for p in (desc, rng):
        if p is not None:
            exprs.update(p.exprs)
    dup_entries: list[str] = []
    if approx_keys:
        approx_keys = list(approx_keys)
        require_columns(df, approx_keys)
        exprs["__dup_unique"] = _approx_unique(approx_keys, rsd)
        subject = ",".join(approx_keys)
        uniq = "least(__dup_unique, __total)"
        dup_entries = [
            _entry("duplicates", subject, "total", "__total"),
            _entry("duplicates", subject, "n_unique", uniq),
            _entry("duplicates", subject, "n_duplicate", f"(__total - {uniq})"),
            _entry("duplicates", subject, "pct_duplicate", pct_sql(f"(__total - {uniq})", "__total")),
        ]

    parts = [p for p in (comp, desc, rng) if p is not None]

    def long() -> list[str]:
        return [e for p in parts for e in p.long()] + dup_entries

    def shape(wide: DataFrame) -> DataFrame:
        # every report row comes from the ONE aggregate row in one Generate; a
        # union of per-check projections would re-run the scan once per check
        return _unpivot(wide, [], long())

    return MetricPlan(exprs, shape, long)


def quality_report(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    rules: Sequence[RangeRule | dict] = (),
    columns: Sequence[str] | None = None,
    describe: bool = True,
    warn_pct: float = 10.0,
    legacy_null_valid: bool = False,
    approx_duplicates: bool = False,
    layout: str = "wide",
) -> DataFrame:
    """Long-form report ``(check, subject, metric, value)``.

    Completeness, statistics and range rules share ONE scan of ``df``; the
    exact duplicate check (when ``keys`` is given) is the only extra branch.
    With ``approx_duplicates`` it joins the same aggregate instead (wide
    layout) or is a shuffle-free second pass (long layout).
    """
    comp_cols = list(columns) if columns is not None else list(df.columns)
    require_columns(df, comp_cols)
    desc_cols = _describe_columns(df, _numeric_among(df, columns)) if describe else []
    rule_list = _rules(df, rules)
    if use_long_layout(layout):
        agg = long_aggregate(df, comp_cols, desc_cols, rule_list)
        fused = _report_from_long(agg, legacy_null_valid)
        if keys:
            dups = duplicate_metrics(df, keys, approx=approx_duplicates)
            fused = fused.unionByName(report_from_parts(None, dups, None, None))
        return fused
    approx_keys = keys if keys and approx_duplicates else None
    fused = quality_plan(df, rule_list, comp_cols, describe, warn_pct, legacy_null_valid,
                         approx_keys).run(df)
    if keys and not approx_duplicates:
        dups = report_from_parts(None, duplicate_metrics(df, keys), None, None)
        fused = fused.unionByName(dups)
    return fused
