import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vitrina.session import build_session
    ckpt = tempfile.mkdtemp(prefix="vitrina-test-ckpt-")
    s = build_session("local[4]", app="vitrina-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
