"""Job specs compiled to one lazy Spark plan, and the job runner."""

from tidyframe.plans.job import (
    JobResult,
    PlannedJob,
    build_frame,
    plan_job,
    run_job,
    transform_frame,
)
from tidyframe.plans.spec import JobSpec, from_legacy_attributes, load_spec

__all__ = ["JobResult", "JobSpec", "PlannedJob", "plan_job", "build_frame", "from_legacy_attributes", "load_spec", "run_job",
           "transform_frame"]
