"""The operators run from any folder, with nothing on the workers' path."""

from __future__ import annotations

import os
import subprocess
import sys

ENTRY = os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "__spark_entry__.py")
RUN = """
import importlib.util, sys
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
for name, query in entry.queries().items():
    if name.startswith("op") and name[2].isdigit() or name == "pipeline":
        query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
        print("ran", name)
"""


def test_every_operator_runs_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", RUN, ENTRY], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    ran = [line for line in done.stdout.splitlines() if line.startswith("ran ")]
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(ran) == 14
