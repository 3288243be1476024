"""bench.py prints one JSON line in the shape the driver records."""

import json
import os
import subprocess
import sys

from .conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g",
               BENCH_QUERIES="geo_atomic,dq_report")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["metric"] == "total_query_sec" and rec["unit"] == "sec"
    assert set(rec["queries"]) == {"geo_atomic", "dq_report"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3)
    assert rec["sf"] == 0.001
