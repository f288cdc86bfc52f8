"""Python workers need no installed package: run from another working directory."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
print("ROWS", E.queries()["pkmc_xlsx"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_worker_side_code_ships_by_value():
    cwd = tempfile.mkdtemp(prefix="linefeed-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 151" in out.stdout, out.stderr[-2000:]
