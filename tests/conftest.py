from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationflow.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("2", name="tests", memory="6g")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session
    session.stop()
