import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeloom.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="lakeloom-test-")
    s = build_session("local[4]", 4, app_name="lakeloom-tests",
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.sql.adaptive.coalescePartitions.enabled": "true"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_base(tmp_path):
    return str(tmp_path)
