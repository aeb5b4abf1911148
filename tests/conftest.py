import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quayside.session import build_session

    session = build_session(master="local[*]", shuffle_partitions=8, app="quayside-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL_SF


@pytest.fixture()
def scratch(spark):
    from quayside.session import work_dir

    return work_dir(spark, "test")
