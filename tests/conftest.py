import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chronolake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("chronolake-tests", master="local[8]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def workdir(spark):
    from chronolake.session import shared_dir

    return shared_dir(spark, "test")
