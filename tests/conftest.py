import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from provtrail.session import local_session

    session = local_session(8, "12g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck(sf_dir):
    from compare import connect

    return connect(sf_dir)
