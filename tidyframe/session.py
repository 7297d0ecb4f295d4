"""Session-level helpers: where a job may put intermediate files.

On a cluster the only folder every executor can see is the shared one the
cluster names in ``spark.checkpoint.dir``.  We read it from the session and
only fall back to a fresh local folder when it is unset (tests, notebooks).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Order: the SparkContext's checkpoint dir, then ``spark.checkpoint.dir``
    from the conf.  When both are unset a local folder is created only in
    local mode (tests); on a cluster this raises instead.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        sc = None
    if sc is None:
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        return conf.rstrip("/")
    root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            # a driver-local folder is invisible to executors on a cluster
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by all executors "
                "(HDFS, object store, NFS) before running jobs that write scratch data"
            )
        conf = tempfile.mkdtemp(prefix="tidyframe-ckpt-")
    sc.setCheckpointDir(conf)
    return (sc.getCheckpointDir() or conf).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/tidyframe/{label}-{uuid.uuid4().hex[:12]}"
