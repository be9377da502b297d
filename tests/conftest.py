import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tablewright.session import get_session
    scratch = tempfile.mkdtemp(prefix="tw-tests-", dir="/tmp")
    s = get_session("local[4]", app="tablewright-tests", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
    })
    # tests only: give the session a checkpoint folder when none is configured
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    s._tw_scratch = scratch
    yield s


@pytest.fixture()
def scratch(spark):
    return tempfile.mkdtemp(prefix="case-", dir=spark._tw_scratch)
