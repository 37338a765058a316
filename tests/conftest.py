import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from glyphlex.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="glyphlex-tests")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from glyphlex.session import scratch_path
    return lambda name: scratch_path(spark, name)
