import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from leakscope.session import build_session
    s = build_session(master=os.environ.get("TEST_MASTER", "local[4]"), shuffle_partitions=8,
                      extra={"spark.driver.memory": "8g",
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ls-wh-")})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ls-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_run():
    return tempfile.mkdtemp(prefix="ls-run-")
