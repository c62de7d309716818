"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_RUNS="1", BENCH_CPUS="2",
               BENCH_QUERIES="rule_702,rule_706")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    result = json.loads(out[-1])
    assert result["unit"] == "sec" and result["sf"] == "0.001"
    assert set(result["queries"]) == {"rule_702", "rule_706"} and "errors" not in result
    assert result["value"] == round(sum(result["queries"].values()), 3)
