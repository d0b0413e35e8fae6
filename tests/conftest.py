import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from vizquarry.session import get_session, ship_package

    session = get_session("tests", 8)
    ship_package(session)
    yield session
    session.stop()
