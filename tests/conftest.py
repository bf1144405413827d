import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from abode.session import build_session, ensure_checkpoint_dir

    s = build_session("local[*]", app_name="abode-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder; on a cluster it comes from the session.
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="abode-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="abode-run-", dir="/tmp")
