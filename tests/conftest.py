import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from zonepulse.session import build_session
    s = build_session("local[*]", "zonepulse-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="zonepulse-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from tools.compare import duck as connect
    return connect(SF_SMALL)


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="zonepulse-test-")
