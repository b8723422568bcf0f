"""Running totals must not depend on how partitions are cut into segments."""

import random

import pytest
from conftest import plan_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrylog.operators.batching import fetch_budget, first_fetch, summarize_batches
from ferrylog.operators.ordered import accumulate, number_rows


def expected(rows):
    out, total, nth, before = [], {}, {}, {}
    for topic, part, off, size in sorted(rows):
        key = (topic, part)
        total[key] = total.get(key, 0) + size
        nth[key] = nth.get(key, 0) + 1
        out.append((topic, part, off, size, total[key], nth[key], before.get(key)))
        before[key] = size
    return sorted(out, key=lambda row: tuple(map(str, row)))


def scanned(frame, **options):
    return accumulate(
        frame,
        sums={"total": F.col("size"), "nth": F.lit(1).cast("bigint")},
        previous={"before": F.col("size")},
        **options,
    ).select("topic", "part", "off", "size", "total", "nth", "before")


SCHEMA = "topic STRING, part INT, off BIGINT, size BIGINT"

logs = st.dictionaries(
    st.tuples(st.sampled_from("ab"), st.integers(0, 1), st.integers(0, 60)), st.integers(0, 9), min_size=1, max_size=40
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(log=logs, span=st.integers(1, 20), fanout=st.integers(2, 5))
def test_any_cut_gives_the_same(make, log, span, fanout):
    rows = [(*key, size) for key, size in log.items()]
    assert rows_of(scanned(make(rows, SCHEMA), span=span, fanout=fanout)) == expected(rows)


def test_hot_partition_with_gaps(make):
    rng = random.Random(7)
    rows = [("hot", 0, off, rng.randint(0, 100)) for off in range(3000) if off % 7 and not 1000 < off < 1900]
    rows += [("cold", part, off, 1) for part in range(4) for off in range(part * 100, part * 100 + 5)]
    for span, fanout in ((1 << 14, 1 << 16), (64, 8), (16, 3)):
        assert rows_of(scanned(make(rows, SCHEMA), span=span, fanout=fanout)) == expected(rows)


def test_previous_value_may_be_null(make):
    rows = [("a", 0, 0, 5), ("a", 0, 1, None), ("a", 0, 2, 7), ("a", 0, 3, 8)]
    got = accumulate(make(rows, SCHEMA), previous={"before": F.col("size")}, span=1)
    assert [row.before for row in got.orderBy("off").collect()] == [None, 5, None, 7]


def test_empty_log(make):
    assert scanned(make([], SCHEMA), span=4).collect() == []


def test_rejected_segments_are_not_read(make):
    rows = [("a", 0, off, 1) for off in range(100)]
    got = number_rows(make(rows, SCHEMA), span=10, reach=lambda before: before["rn"] < 15)
    assert sorted(row.rn for row in got.collect()) == list(range(1, 21))


def test_other_keys_and_order(make):
    rows = [(1, seq, seq % 3) for seq in range(50)]
    got = accumulate(
        make(rows, "part INT, seq BIGINT, code INT"),
        keys=("part",),
        order="seq",
        sums={"zeros": (F.col("code") == 0).cast("bigint")},
        span=8,
    )
    assert {row.seq: row.zeros for row in got.collect()} == {seq: seq // 3 + 1 for _, seq, _ in rows}


def test_rows_are_windowed_by_segment(make):
    plan = plan_of(number_rows(make([("a", 0, 1, 1)], SCHEMA)))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert any("__level" in line for line in windows)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("span", [1, 7])
def test_negative_sizes_do_not_matter(make, span):
    rows = [("a", 0, off, (-1) ** off * off) for off in range(20)]
    assert rows_of(scanned(make(rows, SCHEMA), span=span, fanout=2)) == expected(rows)


def test_rows_are_shuffled_once_without_broadcasts(spark, make):
    frame = make([("a", 0, off, 1) for off in range(50)], SCHEMA)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = scanned(frame, span=8)
        plan = plan_of(got)
        assert rows_of(got) == expected([tuple(row) for row in frame.collect()])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    join = plan.index("SortMergeJoin")
    rows_side = plan[join : plan.index("segments-")]
    by_segment = [line for line in rows_side.splitlines() if "Exchange hashpartitioning" in line and "off" not in line]
    assert sum("__level" in line for line in by_segment) == 2  # the rows, and their segments
    assert "Broadcast" not in plan


@pytest.mark.parametrize("span", [1, 2, 3, 16])
def test_first_fetch_does_not_depend_on_segments(make, span):
    """NULL and empty payloads have no bytes and are within the budget, wherever a segment begins."""
    for sizes in ([10, 0, 1], [None, None, None], [10, None, 0, 5], [12, 0, 1], [0, 0, 10, 0, 0, 1, 0], [3, 3, 4, 0, 0]):
        rows = [("t", 0, off, None if n is None else b"x" * n) for off, n in enumerate(sizes)]
        want, total = [], 0
        for off, n in enumerate(sizes):
            total += n or 0
            if total <= 10 or not off:
                want.append(off)
        got = first_fetch(make(rows, "topic STRING, part INT, off BIGINT, value BINARY"), 10, span=span)
        assert sorted(row.off for row in got.collect()) == want


def test_null_payloads_count_as_empty(make):
    rows = [("t", 0, off, b"xy" if off == 2 else None) for off in range(4)]
    log = make(rows, "topic STRING, part INT, off BIGINT, value BINARY")
    assert [(r.cum_bytes, r.fetch_id) for r in fetch_budget(log, 2, span=1).orderBy("off").collect()] == [(0, 0), (0, 0), (2, 0), (2, 1)]
    assert [r.bytes for r in summarize_batches(log, 2, span=1).orderBy("batch_id").collect()] == [0, 2]
