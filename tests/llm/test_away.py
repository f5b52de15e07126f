"""The queries where the executors' Python cannot import the package."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
RUN = """
import sys
sys.path[:0] = [{root!r}]
from lendscope.session import build_session
spark = build_session("away", "local[4]", **{{"spark.sql.shuffle.partitions": "4", "spark.driver.host": "127.0.0.1", "spark.driver.bindAddress": "127.0.0.1",
    "spark.checkpoint.dir": "file://{folder}", "spark.sql.warehouse.dir": "{folder}/warehouse"}})
def importable(_):
    import importlib.util
    return [importlib.util.find_spec("lendscope") is not None]
assert spark.sparkContext.parallelize([0], 1).mapPartitions(importable).collect() == [False]
import __spark_entry__
for name in {names!r}:
    n = __spark_entry__.queries()[name](spark, {small!r}).count()
    print("rows", name, n)
"""


@pytest.mark.parametrize("names", [["op5_toxicity", "pipeline", "op1_quality", "op3_pieces", "op6_decontaminate", "op8_token_counts", "op9_simhash", "op10_exact_dedup", "op11_conversations", "op12_secrets", "op13_periodic_runs"]])
def test_queries_run_where_executors_lack_the_package(tmp_path, small, names):
    code = RUN.format(root=str(ROOT), folder=tmp_path, names=names, small=small)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    found = dict(line.split()[1:] for line in done.stdout.splitlines() if line.startswith("rows "))
    assert set(found) == set(names) and all(int(n) > 0 for n in found.values())
