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
    from eventide.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="eventide-tests")
    # tests own a scratch checkpoint folder; a cluster names a shared one
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventide-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="eventide-test-")
