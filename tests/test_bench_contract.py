"""bench.py prints one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

from conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_QUERIES="provenance_search_component,lint_report",
               BENCH_REPEATS="1", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    res = json.loads(lines[0])
    assert res["unit"] == "sec" and res["sf"] == 0.001
    assert set(res["queries"]) == {"provenance_search_component", "lint_report"}
    assert res["value"] == round(sum(res["queries"].values()), 3)
    assert res["shuffle_bytes_per_run"]["lint_report"] > 0
