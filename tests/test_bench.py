"""bench.py prints the one JSON line the driver records."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_QUERIES="lookup_features,song_count")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert set(d) == {"metric", "value", "unit", "queries", "sf"}
    assert d["unit"] == "sec" and d["sf"] == "0.001"
    assert set(d["queries"]) == {"lookup_features", "song_count"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-6
