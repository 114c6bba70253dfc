import os
import sys

import pytest

_tests = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(_tests), _tests]

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("millrace-tests", cpus=4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
