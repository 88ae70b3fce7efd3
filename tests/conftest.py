import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from winnowry.session import local_session, use_folder

    session = local_session(8, "winnowry-tests")
    use_folder(session, tempfile.mkdtemp(prefix="run-"))
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")
