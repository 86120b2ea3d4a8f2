import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rankeval.session import get_spark, checkpoint_dir

    s = get_spark("local[4]", shuffle_partitions=4, app="rankeval-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="rankeval-test-")
