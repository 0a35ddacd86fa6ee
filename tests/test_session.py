"""The working folder of a session with and without ``spark.checkpoint.dir``."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from monthgrid.session import shared_dir, stage
builder = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
for pair in sys.argv[1:]:
    builder = builder.config(*pair.split("=", 1))
spark = builder.getOrCreate()
assert stage(spark.range(5), "t").count() == 5
assert shared_dir(spark) == shared_dir(spark)
print("folder", shared_dir(spark), spark.conf.get("spark.checkpoint.dir", None))
"""


def run(tmp_path, *conf):
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT), *conf], env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    return next(line for line in out.stdout.splitlines() if line.startswith("folder")).split()[1:]


def test_local_session_without_a_folder_gets_one(tmp_path):
    folder, named = run(tmp_path)
    assert named == "None" and folder


def test_the_named_folder_is_used(tmp_path):
    folder, named = run(tmp_path, f"spark.checkpoint.dir={tmp_path}/shared")
    assert folder == named == f"{tmp_path}/shared"


def test_a_cluster_must_name_one():
    from monthgrid.session import shared_dir

    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        shared_dir(Session())
