import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from ferrylog.session import build_session  # noqa: E402

DATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[*]",
        shuffle_partitions=8,
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ferrylog-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Rows and a schema text to a frame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def make_log(make):
    """(topic, part, off) or (topic, part, off, value) tuples to a log."""

    def build(rows):
        rows = [tuple(row) + (f"v{row[2]}".encode(),) if len(row) == 3 else tuple(row) for row in rows]
        return make(rows, "topic STRING, part INT, off BIGINT, value BINARY")

    return build


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "run")


def rows_of(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: tuple(map(str, row)))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
