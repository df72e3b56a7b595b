import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shiplens.session import build_session, checkpoint_dir

    s = build_session("local[4]", app_name="shiplens-tests", shuffle_partitions=8)
    # the session setting wins; only without one is a fresh local folder used
    checkpoint_dir(s, local_prefix="shiplens-test-ckpt-")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="shiplens-test-")
