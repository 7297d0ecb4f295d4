"""Row/table operators: de-duplication, projection and quality metrics."""

from tidyframe.operators.columns import drop_columns, select_columns
from tidyframe.operators.dedupe import SortKey, dedupe_report, keep_one
from tidyframe.operators.quality import (
    MetricPlan,
    RangeRule,
    completeness,
    completeness_plan,
    describe_numeric,
    describe_plan,
    duplicate_metrics,
    quality_plan,
    quality_report,
    range_check,
    range_plan,
)

__all__ = [
    "MetricPlan",
    "RangeRule",
    "SortKey",
    "completeness",
    "completeness_plan",
    "dedupe_report",
    "describe_numeric",
    "describe_plan",
    "drop_columns",
    "duplicate_metrics",
    "keep_one",
    "quality_plan",
    "quality_report",
    "range_check",
    "range_plan",
    "select_columns",
]
