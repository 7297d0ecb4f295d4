"""Skew evidence from Spark's event log (no UI).

    python tools/skew_check.py [sf_dir]

Input: the whole ``orders`` table with every third order moved onto ONE hot
customer key (a third of all rows share a key).  For each operator, the event
log of its run gives the largest number of shuffle records any single reduce
task read.  Without map-side reduction that task would read the hot key's
~1/3 of the rows; with it, at most one row per key per map task arrives.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidyframe.operators import dedupe_report, duplicate_metrics, keep_one  # noqa: E402


def _max_shuffle_read_per_task(log_dir: str, group: str) -> tuple[int, int]:
    """(max records read by one task, total records read) for a job group."""
    jobs, stages = set(), set()
    best, total = 0, 0
    for path in glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True):
        with open(path, encoding="utf-8") as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == group:
                        jobs.add(ev["Job ID"])
                        stages.update(ev.get("Stage IDs", []))
                elif kind == "SparkListenerTaskEnd" and ev.get("Stage ID") in stages:
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    n = int(m.get("Total Records Read", 0))
                    best, total = max(best, n), total + n
    return best, total


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="tf-eventlog-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{log_dir}")
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        # keep 8 reduce tasks so the per-task spread is visible (AQE would
        # merge this small shuffle into one task)
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.files.maxPartitionBytes", str(512 * 1024))  # many map tasks
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    skewed = orders.withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("o_custkey"))
    )
    rows = skewed.count()
    hot = skewed.filter(F.col("o_custkey") == -1).count()
    ops = {
        "keep_one_aggregate": lambda: keep_one(skewed, ["o_custkey"], ["o_orderdate desc"]),
        "keep_one_window": lambda: keep_one(skewed, ["o_custkey"], ["o_orderdate desc"],
                                            strategy="window"),
        "duplicate_metrics": lambda: duplicate_metrics(skewed, ["o_custkey"]),
        "dedupe_report": lambda: dedupe_report(skewed, ["o_custkey"]),
    }
    sc = spark.sparkContext
    map_tasks = skewed.rdd.getNumPartitions()
    for name, op in ops.items():
        sc.setJobGroup(name, name)
        op().write.format("noop").mode("overwrite").save()
    sc.setLocalProperty("spark.jobGroup.id", None)
    spark.stop()  # flushes the event log
    out = {"rows": rows, "hot_key_rows": hot, "map_tasks": map_tasks, "operators": {}}
    for name in ops:
        best, total = _max_shuffle_read_per_task(log_dir, name)
        out["operators"][name] = {"max_records_one_task": best, "shuffle_records": total}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
