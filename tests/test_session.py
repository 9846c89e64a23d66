"""The shared folder, in fresh processes."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HEAD = """
from pyspark.sql import SparkSession
from lakeloom.session import build_session, ensure_checkpoint_dir, scratch_path
"""


def run(code, tmp_path):
    env = os.environ | {"PYTHONPATH": REPO, "SPARK_CONF_DIR": str(tmp_path)}
    return subprocess.run([sys.executable, "-c", HEAD + code], env=env, capture_output=True, text=True,
                          timeout=120, cwd=tmp_path)


@pytest.mark.parametrize("code, ok", [
    ("s = build_session('local[1]', 1); assert scratch_path(s, 'x').startswith(ensure_checkpoint_dir(s)); "
     "assert ensure_checkpoint_dir(s) == ensure_checkpoint_dir(s); print('fine')", True),
    ("s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate(); "
     "s.sparkContext.setCheckpointDir('given'); assert '/given/' in ensure_checkpoint_dir(s) + '/'; print('fine')", True),
    ("""
class Stub:
    conf = type('C', (), {'get': staticmethod(lambda k, d=None: 'yarn' if k == 'spark.master' else d)})
    sparkContext = type('S', (), {'getCheckpointDir': staticmethod(lambda: None)})
ensure_checkpoint_dir(Stub)
""", False),
])
def test_checkpoint_folder(code, ok, tmp_path):
    done = run(code, tmp_path)
    assert ("fine" in done.stdout) == ok, done.stderr[-800:]
    assert ok or "spark.checkpoint.dir" in done.stderr
