import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from plotwise.session import get_session
    folder = "file://" + tempfile.mkdtemp(prefix="plotwise-ckpt-", dir="/tmp")
    s = get_session("local[4]", 4, app_name="plotwise-tests", extra={"spark.checkpoint.dir": folder})
    yield s
    s.stop()
