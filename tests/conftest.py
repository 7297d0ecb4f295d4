from __future__ import annotations

import os
import sys
import tempfile
import uuid

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("tidyframe-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder only where the session has none
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tf-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture
def scratch():
    """A fresh folder per test (never cleaned up by the tests)."""
    return tempfile.mkdtemp(prefix="tf-test-", dir="/tmp")


def count_jobs(spark, fn) -> int:
    """Number of Spark jobs ``fn`` launches (status tracker, no UI)."""
    sc = spark.sparkContext
    group = f"count-{os.getpid()}-{uuid.uuid4().hex}"
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def plan_text(df, mode: str = "formatted") -> str:
    """``df.explain(mode)`` output as a string."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
