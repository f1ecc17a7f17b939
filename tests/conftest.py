import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loadkit.session import build_session, work_path  # noqa: E402

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
AS_OF = "2024-01-31 00:00:00"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", app="tests", driver_memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return lambda label="t": work_path(spark, label)


@pytest.fixture(scope="session")
def sf():
    return SF
