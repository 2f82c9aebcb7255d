"""bench.py prints one JSON line with per-query seconds."""

import json
import os
import subprocess
import sys

from tests.conftest import SF0001

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF0001, BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g")
    proc = subprocess.run(
        [sys.executable, os.path.join(REPO, "bench.py"), "kafka_row_decode", "route_quantitative"],
        capture_output=True, text=True, timeout=600, env=env, cwd=REPO,
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [ln for ln in proc.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001 and set(out["queries"]) == {"kafka_row_decode", "route_quantitative"}
    assert out["value"] == round(sum(out["queries"].values()), 3) and out["rows"]["route_quantitative"] > 0
