import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
from brightloom.session import local_session
from brightloom.staging import stage, stage_root
spark = local_session(cores="1", shuffle_partitions=1)
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert stage(spark.range(3), "t").count() == 3 and stage_root(spark) == stage_root(spark)
print("staged")
"""


def test_a_session_without_any_configuration_can_stage(tmp_path):
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": REPO, "PYSPARK_SUBMIT_ARGS": "pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", CODE], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert "staged" in out.stdout, out.stderr[-2000:]
