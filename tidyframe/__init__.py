"""tidyframe: lazy, composable data-preparation operators on Spark DataFrames.

read (files / JDBC) -> de-duplicate -> clean -> cast -> enrich -> profile ->
write, each step a ``DataFrame -> DataFrame`` function over built-in Spark
expressions, plus a declarative job spec and an incremental file ingest.
"""

from tidyframe.errors import MissingColumnError, SpecError
from tidyframe.operators import (
    completeness,
    dedupe_report,
    describe_numeric,
    duplicate_metrics,
    keep_one,
    quality_report,
    range_check,
)
from tidyframe.plans import JobSpec, load_spec, plan_job, run_job
from tidyframe.sinks import SinkSpec, write_sink
from tidyframe.sources import SourceSpec, read_source
from tidyframe.streaming import ingest_files

__version__ = "0.1.0"

__all__ = [
    "JobSpec",
    "MissingColumnError",
    "SinkSpec",
    "SourceSpec",
    "SpecError",
    "completeness",
    "dedupe_report",
    "describe_numeric",
    "duplicate_metrics",
    "ingest_files",
    "keep_one",
    "load_spec",
    "plan_job",
    "quality_report",
    "range_check",
    "read_source",
    "run_job",
    "write_sink",
]
