"""bench.py keeps the driver contract: exactly one JSON line on stdout."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF_SMALL, "BENCH_RUNS": "1",
           "BENCH_ONLY": "scan_parquet,completeness", "BENCH_CPUS": "2"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] == "total_sec" and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"scan_parquet", "completeness"} and not d["errors"]
    assert d["value"] == round(sum(d["queries"].values()), 4)
