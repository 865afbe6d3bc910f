import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from labelscope.runtime import local_session, scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8")
    session.sparkContext.setLogLevel("ERROR")
    with scratch(session):
        yield session
