"""Every registered query against SQL on the same tables."""

import math

import duckdb
import pandas as pd
import pytest
from conftest import DATA

from ferrylog.plans.oracle import ORACLE, with_ctes
from ferrylog.plans.queries import QUERIES
from ferrylog.plans.streams import STREAMS


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else int(value) if value.is_integer() else value
    if isinstance(value, (bool, int)):
        return value
    return str(value)


def canonical(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(map(plain, row)) for row in frame.values.tolist()), key=lambda row: tuple(map(str, row)))


@pytest.fixture(scope="module")
def duck():
    made = {}

    def connect(folder):
        if folder not in made:
            made[folder] = duckdb.connect()
            for file in folder.glob("*.parquet"):
                made[folder].execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        return made[folder]

    return connect


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    folder = DATA / ("sf0.001" if name in STREAMS else "sf0.01")
    if not folder.exists():
        pytest.skip("no test data")
    got = QUERIES[name](spark, str(folder)).toPandas()
    expected = duck(folder).execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert canonical(got) == canonical(expected)


def test_fresh_rows_are_reached_on_small_data(spark, duck):
    """On the smallest folder some partitions have no failures, so both branches of a replay are met."""
    folder = DATA / "sf0.001"
    if not folder.exists():
        pytest.skip("no test data")
    got = QUERIES["replay_failed"](spark, str(folder)).toPandas()
    assert set(got["replayed"]) == {True, False}
    assert canonical(got) == canonical(duck(folder).execute(ORACLE["replay_failed"]).df())


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


def test_unknown_input_is_refused():
    with pytest.raises(KeyError):
        with_ctes("log nothing", "SELECT 1")
