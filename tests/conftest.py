import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("MARQUEE_TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from marquee.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8, app="marquee-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="marquee-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    from marquee.plans.check import duck as make
    return make(sf_dir)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="marquee-test-")
