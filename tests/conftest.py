from __future__ import annotations

import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
for path in (HERE, os.path.dirname(HERE)):
    if path not in sys.path:
        sys.path.insert(0, path)

from tillroll import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(shuffle_partitions=8, driver_memory="6g", app_name="tillroll-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillroll-test-ckpt-"))
    yield s
