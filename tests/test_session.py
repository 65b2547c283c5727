"""The scratch folder in a session without any configuration."""

from __future__ import annotations

import os
import subprocess
import sys

SCRIPT = """
from pyspark.sql import SparkSession
from tripspark.session import new_scratch_dir, scratch_root
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
first = scratch_root(spark)
path = new_scratch_dir(spark, "kind")
assert scratch_root(spark) == first and path.startswith(first + "/kind-"), (first, path)
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3
spark.stop()
"""


def test_scratch_folder_with_an_empty_configuration(tmp_path):
    (tmp_path / "conf").mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": root, "TMPDIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
