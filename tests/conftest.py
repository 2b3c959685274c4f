import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import local_session

    s = local_session("*", shuffle_partitions=8, app="strata-tests")
    yield s
    s.stop()


@pytest.fixture
def tmp_folder(spark):
    from strata.session import scratch_path

    return scratch_path(spark, "test")
