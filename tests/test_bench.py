"""bench.py runs every query and prints one JSON line in the expected shape."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_RUNS="1", BENCH_CPUS="4")
    p = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd="/tmp",
                       capture_output=True, text=True, timeout=900)
    assert p.returncode == 0, p.stderr[-2000:]
    lines = [ln for ln in p.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["metric"] and d["sf"] == 0.001
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    assert set(d["queries"]) == set(E.queries())
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
    assert d["failed"] == {}
