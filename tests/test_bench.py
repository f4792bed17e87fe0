"""bench.py prints one JSON line with per-query times."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    events = tempfile.mkdtemp(prefix="percepta-events-")
    env = dict(
        os.environ,
        BENCH_SF_DIR="/root/testdata/sf0.001",
        BENCH_CPUS="2",
        BENCH_QUERIES="feature_columns,hash_split,mlp_report",
        BENCH_EVENT_LOG_DIR=events,
    )
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env, capture_output=True, text=True, timeout=600, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    rec = json.loads(out[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"feature_columns", "hash_split", "mlp_report"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 1e-6
    assert len(rec["training_steps"]["mlp_report"]) == 1 and rec["training_steps"]["mlp_report"][0] > 10
    assert os.listdir(events)  # an event log was written
