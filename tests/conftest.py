import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)



@pytest.fixture(scope="session")
def spark():
    from tidal.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=4, app_name="tidal-tests")
    yield s
    s.stop()
