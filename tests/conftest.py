from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ratelake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus=2, shuffle_partitions=2, app_name="ratelake-tests", driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="ratelake-test-")
