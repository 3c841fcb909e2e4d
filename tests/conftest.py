import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from veredas.session import local_session, reachable  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, "tests")
    s.sparkContext.setLogLevel("ERROR")
    yield reachable(s)
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
