"""bench.py prints exactly one JSON line with the keys the driver reads."""
import json
import os
import subprocess
import sys

from conftest import ROOT, SF001


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="user_totals,topn_sliding")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"user_totals", "topn_sliding"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-6


def test_cli_list_and_run(tmp_path):
    listed = subprocess.run([sys.executable, "-m", "clickflow", "list"], cwd=ROOT, capture_output=True, text=True,
                            timeout=120, check=True).stdout
    assert "topn_sliding" in listed and "reconcile" in listed
    out = tmp_path / "totals"
    subprocess.run([sys.executable, "-m", "clickflow", "run", "user_totals", SF001, str(out)], cwd=ROOT,
                   capture_output=True, text=True, timeout=600, check=True)
    import pyarrow.parquet as pq
    assert pq.read_table(str(out)).num_rows > 0
