import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from slotwise.session import local_session

    s = local_session("4", shuffle_partitions=4, app="slotwise-tests")
    yield s
    s.stop()
