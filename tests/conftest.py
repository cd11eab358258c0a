import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from agrolens.session import get_spark
    s = get_spark("local[4]", 8, app_name="agrolens-tests", driver_memory="8g")
    yield s


SF_SMALL = "/root/testdata/sf0.001"
