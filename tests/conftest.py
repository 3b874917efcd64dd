import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ridgeline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, 4, "6g")
    session.sparkContext.setCheckpointDir(f"file://{tmp_path_factory.mktemp('shared')}")
    yield session
    session.stop()
