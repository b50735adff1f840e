import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

@pytest.fixture(scope="session")
def spark():
    from shopfloor import session
    s = session.local_session("*", shuffle_partitions=8, app="shopfloor-tests")
    yield s
    s.stop()
