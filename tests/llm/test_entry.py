from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
for _ in range(2):
    print("rows", entry.queries()["op3_secret_scan"](spark, "/root/testdata/sf0.001").count())
"""


def test_entry_loaded_by_path_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, f"{ROOT}/__spark_entry__.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.count("rows 200") == 2, done.stderr[-3000:]
