import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from wagelens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return os.path.join(os.environ.get("TESTDATA_DIR", "/root/testdata"), "sf0.001")
