import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tillworks.session import build_session

    session = build_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    from tillworks.session import remove_scratch

    remove_scratch(session)
    session.stop()
