import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weblytics.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "weblytics-tests", memory="4g")
    yield session
    session.stop()


@pytest.fixture
def plan():
    """Text of the physical plan."""
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF
