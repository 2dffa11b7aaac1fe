import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from scrubstat.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", app="scrubstat-tests", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF
