import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", master="local[8]", shuffle_partitions=4, memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
