import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from airshed.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="airshed-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a DataFrame as a sorted list of dicts, or a DataFrame from tuples and a DDL."""

    def make(data, ddl):
        return spark.createDataFrame(data, ddl)

    return make


def dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
