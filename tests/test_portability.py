"""Queries whose code runs in Python workers work when the driver is started
from another directory (workers cannot import the repo from their cwd)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(REPO, "__spark_entry__.py")!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").getOrCreate())
q = E.queries()
print("COUNTS", q["fsm"](spark, "/root/testdata/sf0.001").count(),
      q["stream_fsm"](spark, "/root/testdata/sf0.001").count())
"""


def test_worker_code_runs_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="elsewhere-", dir="/tmp")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("COUNTS")]
    assert line and line[0].split()[1:] == ["1000", "1000"], out.stderr[-2000:]
