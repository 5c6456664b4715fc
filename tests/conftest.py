import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    ckpt = tempfile.mkdtemp(prefix="strata-test-ckpt-")
    s = build_session("local[4]", app_name="strata-tests", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    from strata.session import work_path
    return work_path(spark, "test")
