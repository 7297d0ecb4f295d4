"""Run a job spec:  ``python -m tidyframe job.yml``, or
``spark-submit --py-files tidyframe.zip tidyframe/__main__.py job.yml``.

The session comes from the launcher (``spark-submit`` settings or
``spark-defaults.conf``); nothing here chooses a master or resources.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from tidyframe.errors import SpecError
from tidyframe.plans import load_spec, plan_job, run_job


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidyframe", description=__doc__)
    ap.add_argument("spec", help="YAML job spec (new layout or root `attributes:`)")
    ap.add_argument("--checkpoint", help="checkpoint path for incremental ingest "
                    "(older layout with move_processed_files)")
    ap.add_argument("--run-date", help="processing date YYYY-MM-DD (default: today, UTC)")
    ap.add_argument("--explain", action="store_true", help="print the write plan and stop")
    args = ap.parse_args(argv)
    try:
        spec = load_spec(args.spec, checkpoint=args.checkpoint)
    except SpecError as ex:
        print(f"spec error: {ex}", file=sys.stderr)
        return 2
    run_date = run_ts = None
    if args.run_date:
        run_date = dt.date.fromisoformat(args.run_date)
        run_ts = dt.datetime.combine(run_date, dt.time())
    spark = SparkSession.builder.appName("tidyframe").getOrCreate()
    if args.explain:
        try:
            planned = plan_job(spark, spec, run_date, run_ts)
        except SpecError as ex:
            print(f"spec error: {ex}", file=sys.stderr)
            return 2
        planned.frame.explain("formatted")
        return 0
    result = run_job(spark, spec, run_date, run_ts)
    written = "" if result.rows_written is None else f"{result.rows_written} rows "
    print(f"wrote {written}to {result.output_path} (run {result.run_ts.isoformat()})")
    if result.report is not None:
        # all of it: its size follows from the schema, not from the data
        result.report.show(max(result.report.count(), 1), truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
