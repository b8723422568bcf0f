"""Last known values, against a look at all facts."""

from datetime import datetime

from conftest import plan_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrylog.operators import asof

ROWS = "topic STRING, part INT, off BIGINT, t BIGINT"
FACTS = "topic STRING, part INT, since BIGINT, nth INT, leader INT"

key = st.tuples(st.sampled_from("ab"), st.integers(0, 1))
moment = st.integers(-50, 200)


def expected(rows, facts):
    out = []
    for topic, part, off, t in rows:
        known = [f for f in facts if f[:2] == (topic, part) and t is not None and f[2] is not None and f[2] <= t]
        out.append((topic, part, off, t, max(known, key=lambda f: f[2:4])[4] if known else None))
    return sorted(out, key=lambda row: tuple(map(str, row)))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(key, st.one_of(st.none(), moment)), max_size=25),
    facts=st.lists(st.tuples(key, st.one_of(st.none(), moment), st.one_of(st.none(), st.integers(0, 3))), max_size=25),
    width=st.sampled_from([1, 7, 1000]),
)
def test_every_row_gets_the_last_fact(make, rows, facts, width):
    rows = [(*k, n, t) for n, (k, t) in enumerate(rows)]
    facts = [(*k, t, n, leader) for n, (k, t, leader) in enumerate(facts)]
    got = asof.as_of(make(rows, ROWS), make(facts, FACTS), ["leader"], at="t", tie="nth", width=width)
    assert sorted(rows_of(got), key=lambda row: tuple(map(str, row))) == expected(rows, facts)


def test_one_moment_without_a_tie(make):
    facts = make([("a", 0, 5, 1, 3), ("a", 0, 5, 2, 2)], FACTS)
    assert rows_of(asof.as_of(make([("a", 0, 0, 5)], ROWS), facts, ["leader"], at="t")) == [("a", 0, 0, 5, 3)]


def test_other_columns_of_rows_and_facts_may_share_names(make):
    rows = make([("a", 0, 0, 5, 9)], f"{ROWS}, since INT")
    facts = make([("a", 0, 1, 1, 3)], FACTS)
    assert rows_of(asof.as_of(rows, facts, ["leader"], at="t")) == [("a", 0, 0, 5, 9, 3)]


def test_micros_do_not_depend_on_the_zone(spark, make):
    times = [datetime(2024, 3, 10, 2, 30), datetime(2024, 3, 10, 3, 10), datetime(1969, 12, 31, 23, 59, 59, 999_999), None]
    frame = make([(n, t) for n, t in enumerate(times)], "n INT, ts TIMESTAMP_NTZ").select("n", asof.micros(F.col("ts")).alias("us"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [row.us for row in frame.orderBy("n").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [1_710_037_800_000_000, 1_710_040_200_000_000, -1, None]


def test_rows_stay_where_they_are(make):
    """Facts are broadcast by their size; the rows meet neither a sort nor a window."""
    rows = make([("a", 0, n, n) for n in range(50)], ROWS)
    plan = plan_of(asof.as_of(rows, make([("a", 0, 5, 1, 3), ("a", 0, 9, 2, 2)], FACTS), ["leader"], at="t"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Window" not in plan
