"""A session on a plain install, without any preset configuration."""

import os
import subprocess
import sys

from conftest import ROOT

SCRIPT = """
from comparo.session import build_session, materialize
spark = build_session("local[2]", 2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
table = materialize(spark.range(10), "numbers")
assert table.count() == 10 and "/tables/" in table.inputFiles()[0]
print("started")
"""


def test_session_starts_without_a_preset_checkpoint_folder(tmp_path):
    (tmp_path / "conf").mkdir()
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": ROOT, "COMPARO_SCRATCH": str(tmp_path),
                        "COMPARO_DRIVER_MEMORY": "1g"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=150)
    assert "started" in done.stdout, done.stderr[-2000:]
