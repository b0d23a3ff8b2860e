import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from coinwharf.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "coinwharf-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture(scope="session")
def run_ts():
    return dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
