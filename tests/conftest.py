import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from arbiter.session import build_session
    s = build_session("local[4]", 8, app_name="arbiter-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="arbiter-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
