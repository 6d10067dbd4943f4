import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from touchline.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("touchline-tests", master="local[4]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="touchline-test-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's shared work root."""
    import uuid
    from touchline.session import work_root
    return f"{work_root(spark)}/touchline-tests/{uuid.uuid4().hex[:10]}"
