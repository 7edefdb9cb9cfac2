import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from mercato.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="mercato-tests",
                      conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="mercato-test-wh-")})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="mercato-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="mercato-test-")
