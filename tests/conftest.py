import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rillet.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8)
    yield s
    s.stop()


@pytest.fixture
def lines(spark):
    def make(values, with_time=False):
        if with_time:
            return spark.createDataFrame(values, "value string, arrival_ts timestamp")
        return spark.createDataFrame([(v,) for v in values], "value string")
    return make
