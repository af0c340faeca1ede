import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from eventflow.session import get_session
    s = get_session("local[4]", shuffle_partitions=4)
    # tests only: a private checkpoint folder when the session names none
    if not s.sparkContext.getCheckpointDir() and not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventflow-test-"))
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
