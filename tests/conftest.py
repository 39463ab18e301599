import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from clipstat.session import build_session

    s = build_session("local[4]", app_name="clipstat-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("FATAL")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="clipstat-test-")
