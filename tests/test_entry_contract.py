"""The driver loads __spark_entry__.py by path from its own directory: pandas-UDF
queries must still find the package on the Python workers."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("spark_entry", {os.path.join(REPO, "__spark_entry__.py")!r})
e = importlib.util.module_from_spec(spec); spec.loader.exec_module(e)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
assert e.entry(spark).count() > 0
r = e.queries()["ipw_ate_logit"](spark, "/root/testdata/sf0.001").first()
print("ATE", r.ate)
"""


def test_entry_from_foreign_directory():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(prefix="entry-cwd-"),
                         capture_output=True, text=True, timeout=600, env=env)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "ATE" in out.stdout
