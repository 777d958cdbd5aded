import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from starling.session import build_session, shared_root

    s = build_session("local[4]", shuffle_partitions=4, app_name="starling-tests")
    shared_root(s)  # sets a checkpoint dir only where the session has none
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    """A fresh folder below the shared root for one test."""
    from starling.session import shared_path

    return shared_path(spark, "tests", unique=True)


@pytest.fixture()
def local_tmp():
    return tempfile.mkdtemp(prefix="starling-test-")
