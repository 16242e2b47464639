import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quillmill.session import build_session

    session = build_session("local[4]", 4, **{"spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
