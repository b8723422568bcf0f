"""Sets of offsets as ranges, against sets in Python."""

import pytest
from conftest import plan_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ferrylog.operators import ranges

OFFSETS = "topic STRING, part INT, off BIGINT"
RANGES = "topic STRING, part INT, low BIGINT, high BIGINT"

few = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
places = st.tuples(st.sampled_from("ab"), st.integers(0, 1), st.one_of(st.integers(0, 140), st.integers(16_370, 16_400)))
loose = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 1), st.integers(0, 40_000), st.integers(-2, 300)), max_size=8)


def expected(offsets):
    """Longest runs of a set of (topic, part, offset), in the order of ``rows_of``."""
    out = []
    for topic, part, off in sorted(offsets):
        if out and out[-1][:2] == (topic, part) and out[-1][3] == off - 1:
            out[-1] = (topic, part, out[-1][2], off)
        else:
            out.append((topic, part, off, off))
    return in_order(out)


def in_order(rows):
    return sorted(rows, key=lambda row: tuple(map(str, row)))


def members(rows):
    return {(t, p, off) for t, p, low, high in rows for off in range(low, high + 1)}


def as_ranges(rows):
    return [(t, p, low, low + length) for t, p, low, length in rows]


@few
@given(offsets=st.lists(places, max_size=60))
def test_ranges_of_offsets(make, offsets):
    assert rows_of(ranges.of_offsets(make(offsets + offsets[:3], OFFSETS))) == expected(set(offsets))


@few
@given(left=loose, right=loose)
def test_algebra(make, left, right):
    left, right = as_ranges(left), as_ranges(right)
    a, b = members(left), members(right)
    frames = make(left, RANGES), make(right, RANGES)
    assert rows_of(ranges.union(*frames)) == expected(a | b)
    assert rows_of(ranges.intersection(*frames)) == expected(a & b)
    assert rows_of(ranges.difference(*frames)) == expected(a - b)


@few
@given(offsets=st.lists(places, max_size=30), held=loose)
def test_containment_and_inflight(make, offsets, held):
    held = as_ranges(held)
    rows, inside, emitted = make(offsets, OFFSETS), members(held), set(offsets)
    got = ranges.contained(rows, ranges.normalised(make(held, RANGES)))
    assert rows_of(got) == in_order((*row, row in inside) for row in offsets)
    wanted = []
    for topic, part in sorted({row[:2] for row in emitted}):
        own = {row for row in emitted if row[:2] == (topic, part)}
        still = own - inside
        safe = min(row[2] for row in still) if still else max(row[2] for row in own) + 1
        wanted.append((topic, part, len(still), len(expected(still)), safe))
    assert rows_of(ranges.inflight(ranges.of_offsets(rows), make(held, RANGES))) == in_order(wanted)


def test_a_word_that_is_full_and_the_highest_bit(make):
    offsets = [("a", 0, off) for off in range(0, 128)] + [("a", 0, 191), ("a", 0, 192), ("a", 1, 63), ("a", 2, None)]
    assert rows_of(ranges.of_offsets(make(offsets, OFFSETS))) == [("a", 0, 0, 127), ("a", 0, 191, 192), ("a", 1, 63, 63)]


def test_long_ranges_are_not_unrolled(make):
    """A million million offsets and the two in them that fail."""
    all_of, bad = make([("a", 0, 0, 10**12)], RANGES), make([("a", 0, 7, 7), ("a", 0, 10**11, 10**11)], RANGES)
    left = [("a", 0, 0, 6), ("a", 0, 8, 10**11 - 1), ("a", 0, 10**11 + 1, 10**12)]
    assert rows_of(ranges.difference(all_of, bad)) == in_order(left)


def test_empty_sets_and_missing_ends(make):
    nothing = make([], RANGES)
    assert rows_of(ranges.union(nothing, nothing)) == []
    odd = make([("a", 0, None, 4), ("a", 0, 3, None), ("a", 0, 5, 4), ("a", 0, 1, 1)], RANGES)
    assert rows_of(ranges.normalised(odd)) == [("a", 0, 1, 1)]
    assert rows_of(ranges.below(make([("a", 0, 2, 2), ("a", 1, 2, 5)], "topic STRING, part INT, earliest BIGINT, committed BIGINT"))) == [("a", 1, 2, 4)]


def test_no_single_offset_is_shuffled(spark):
    """Offsets are words before the exchange: 5,000 of one run are 79 rows, and nothing else is written or moved."""
    run = spark.range(0, 5_000, 1, 4).selectExpr("'a' AS topic", "0 AS part", "id AS off")
    words = ranges.words_of(run)
    plan = plan_of(words)
    assert plan.count("HashAggregate") == 2 and plan.index("Exchange") < plan.rindex("HashAggregate")  # printed from its end
    assert plan.count("Exchange") == 1 and words.count() == 79


@pytest.mark.parametrize("rule", [ranges.union, ranges.difference, ranges.intersection])
def test_results_are_normal(make, rule):
    left = make([("a", 0, 0, 9), ("a", 0, 10, 19), ("a", 0, 5, 25)], RANGES)
    got = rule(left, make([("a", 0, 12, 14), ("a", 0, 15, 15)], RANGES))
    assert rows_of(got) == rows_of(ranges.normalised(got))
