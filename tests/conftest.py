import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pitchline.settings import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, **{"spark.sql.shuffle.partitions": "2"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
