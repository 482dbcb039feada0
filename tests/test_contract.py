"""The driver contract: bench.py prints one JSON line; entry/queries/oracle
line up."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry_mod
from tallyflow.plans.queries import all_queries

REPO = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "2"}
    out = subprocess.run(
        [sys.executable, str(REPO / "bench.py"), "payments_normalised", "first_orders"],
        capture_output=True, text=True, env=env, timeout=600, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert d["metric"] and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"payments_normalised", "first_orders"}
    assert d["value"] == round(sum(d["queries"].values()), 3) and "errors" not in d


def test_every_query_has_an_oracle():
    # The training-data operators that SQL cannot express have their own tests.
    assert set(all_queries()) <= set(entry_mod.queries())
    assert set(all_queries()) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
