import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="ledgerline-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lw-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)
