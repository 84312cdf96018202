import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from relcast.session import get_spark

    s = get_spark("local[4]", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="relcast-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_folder(tmp_path):
    return str(tmp_path)
