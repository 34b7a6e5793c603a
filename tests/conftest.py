import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from binledger.session import clear_stage, local_session

    session = local_session(4, shuffle_partitions=4, app="binledger-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_stage(session)
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip(f"no test tables at {DATA}")
    return DATA
