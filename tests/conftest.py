import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from abx.session import build_session
    scratch = tempfile.mkdtemp(prefix="abx-test-")
    s = build_session("local[4]", 4, app_name="abx-tests", extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.driver.memory": "4g",
    })
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="abx-t-")
