import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderlens.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("orderlens-tests", master="local[*]", shuffle_partitions=4, extra={"spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
