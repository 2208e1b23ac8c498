"""bench.py prints the one-line JSON contract the driver records."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_REPEAT": "1",
           "BENCH_QUERIES": "cohort_summary,dedup_latest", "BENCH_CPUS": "2"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, cwd=ROOT)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["metric"] and d["sf"] == 0.001
    assert set(d["queries"]) == {"cohort_summary", "dedup_latest"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
    assert d["work_per_run"]["dedup_latest"]["stages"] >= 1
