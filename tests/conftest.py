import os
import sys
import tempfile

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(__file__)]

from pacewatch.session import local_session, use_checkpoints  # noqa: E402

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        4, spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="warehouse-"), spark__driver__memory="6g"
    )
    use_checkpoints(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA
