"""bench.py prints exactly one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

from .conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF001, "BENCH_CPUS": "4", "BENCH_QUERIES": "headline"}
    res = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=900, cwd=ROOT)
    assert res.returncode == 0, res.stderr[-2000:]
    lines = [ln for ln in res.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["value"] > 0 and d["sf"] == 0.001
    assert {"pipeline_clean_and_features", "lapse_by_age_bucket", "scorecard"} <= set(d["queries"])
