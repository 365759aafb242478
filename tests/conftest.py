import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripkpi.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture()
def tmp_dir(spark):
    """A fresh folder under the session's checkpoint root."""
    from tripkpi.session import scratch_path
    return scratch_path(spark, "test")
