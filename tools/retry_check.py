"""Metrics stay exact when tasks fail and are retried.

    python tools/retry_check.py [sf_dir]

Runs the registered end-to-end job twice on ``local[4, 4]`` (up to 4 attempts
per task): once clean, once with the first attempt of every even-numbered task
failing both before the dedupe shuffle (map stage) and in the write (result)
stage.  Prints whether the written rows are identical and every count in
the quality report is exact (means / standard deviations may differ in the
last bits: retries change the order in which partial sums merge).  (Diagnostic only: the failure is injected with a tiny Python UDF
wrapped around the job's reader and layout steps.)
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import tidyframe.plans.job as job  # noqa: E402
from tidyframe import registry as R  # noqa: E402
from tidyframe.session import scratch_path  # noqa: E402


def _fail_first_attempt(x):
    tc = TaskContext.get()
    if tc.attemptNumber() == 0 and tc.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return x


def _flaky(df, column):
    return df.withColumn(column, F.udf(_fail_first_attempt, "string")(F.col(column)))


def _report(result):
    return sorted((r["check"], r["subject"], r["metric"], r["value"])
                  for r in result.report.collect())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[4, 4]")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.files.maxPartitionBytes", str(256 * 1024))
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    src = R._job_input(spark, sf_dir)

    clean_out = scratch_path(spark, "retry-clean")
    clean = job.run_job(spark, R.job_spec(src, clean_out), R.AS_OF, R.RUN_TS)

    read_source, prepare_layout = job.read_source, job.prepare_layout
    job.read_source = lambda s, spec: _flaky(read_source(s, spec), "priority_note")
    job.prepare_layout = lambda df, spec, **kw: _flaky(prepare_layout(df, spec, **kw), "status")
    try:
        flaky_out = scratch_path(spark, "retry-flaky")
        flaky = job.run_job(spark, R.job_spec(src, flaky_out), R.AS_OF, R.RUN_TS)
    finally:
        job.read_source, job.prepare_layout = read_source, prepare_layout

    same_rows = (spark.read.parquet(clean_out).exceptAll(spark.read.parquet(flaky_out)).count() == 0
                 and spark.read.parquet(flaky_out).exceptAll(spark.read.parquet(clean_out)).count() == 0)
    a, b = _report(clean), _report(flaky)
    # means / standard deviations are sums of doubles: retried tasks finish in
    # another order, so partial sums merge in another order (last-bit noise);
    # every count, min, max and percentage must be identical
    float_metrics = {"mean", "stddev"}
    exact = all(x == y for x, y in zip(a, b) if x[2] not in float_metrics)
    rel = max((abs(x[3] - y[3]) / max(abs(x[3]), 1e-300)
               for x, y in zip(a, b) if x[2] in float_metrics and x[3] != y[3]), default=0.0)
    print(json.dumps({
        "rows_written": [clean.rows_written, flaky.rows_written],
        "same_rows": same_rows,
        "same_keys": [x[:3] for x in a] == [y[:3] for y in b],
        "counts_exact": exact,
        "float_max_rel_diff": rel,
        "report_rows": len(a),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
