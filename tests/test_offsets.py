"""Start positions, repair and lag on literal rows."""

import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from ferrylog.operators import offsets

BOUNDS = "topic STRING, part INT, earliest BIGINT, latest BIGINT"
SAVED = "topic STRING, part INT, job_id STRING, committed BIGINT"


@pytest.fixture
def bounds(make):
    return make([("t", part, 100, 200) for part in range(8)], BOUNDS)


@pytest.fixture
def saved(make):
    rows = [(1, "mine", 99), (2, "mine", 100), (3, "mine", 200), (4, "mine", 201), (5, "mine", -5), (6, "other", 150), (7, None, 150)]
    return make([("t", *row) for row in rows], SAVED)


def by_part(df, *columns):
    return {row["part"]: tuple(row[c] for c in columns) if len(columns) > 1 else row[columns[0]] for row in df.collect()}


def test_bounds_count_gaps(make_log):
    log = make_log([("t", 0, 3), ("t", 0, 4), ("t", 0, 9), ("t", 1, 0)])
    assert rows_of(offsets.offset_bounds(log)) == [("t", 0, 3, 10, 3, 4), ("t", 1, 0, 1, 1, 0)]


def test_resolve_start_keeps_a_position_past_the_end(bounds, saved):
    got = by_part(offsets.resolve_start(bounds, saved), "start_off")
    assert got == {0: 100, 1: 100, 2: 100, 3: 200, 4: 201, 5: 100, 6: 150, 7: 150}


def test_resolve_start_is_never_below_earliest(make):
    bounds = make([("t", part, part * 7 % 11, 50) for part in range(30)], BOUNDS)
    saved = make([("t", part, "j", part - 5) for part in range(30)], SAVED)
    got = offsets.resolve_start(bounds, saved)
    assert got.where("start_off < earliest").isEmpty()


def test_resolve_start_job_reasons(bounds, saved):
    def reasons(**options):
        got = offsets.resolve_start_job(bounds, saved, job_id="mine", **options)
        return by_part(got, "start_off", "reason")

    plain = reasons()
    assert plain[0] == (100, "no_record") and plain[7] == (100, "no_record")
    assert plain[1] == (99, "saved") and plain[6] == (150, "saved")
    assert plain[5] == (100, "non_positive")
    assert reasons(force=True)[6] == (100, "forced")
    behind = reasons(start="latest", max_behind=60)
    assert behind[2] == (200, "too_far") and behind[6] == (150, "saved") and behind[3] == (200, "saved")


def test_a_saved_zero_counts_as_no_position(make):
    got = offsets.resolve_start_job(make([("t", 0, 0, 9)], BOUNDS), make([("t", 0, "j", 0)], SAVED), job_id="j", start="latest")
    assert by_part(got, "start_off", "reason") == {0: (9, "non_positive")}


@pytest.mark.parametrize("policy, reset", [("earliest", 100), ("latest", 200)])
def test_out_of_range(bounds, saved, policy, reset):
    got = by_part(offsets.out_of_range(bounds, saved, policy=policy), "status", "reset_off")
    assert got[0] == ("no_record", reset)
    assert got[1] == ("below", reset)
    assert got[2] == ("in_range", 100)
    assert got[3] == ("in_range", 200)
    assert got[4] == ("above", reset)
    assert got[5] == ("below", reset)


def test_out_of_range_policy_is_checked(bounds, saved):
    with pytest.raises(ValueError):
        offsets.out_of_range(bounds, saved, policy="newest")


def test_out_of_range_can_fail_the_job(make, bounds, saved):
    fine = saved.where("part IN (2, 3)")
    assert by_part(offsets.out_of_range(bounds, fine, policy="fail"), "reset_off")[3] == 200
    with pytest.raises(Exception, match="offset 201 of t, partition 4, is out of range"):
        offsets.out_of_range(bounds, saved.where("part = 4"), policy="fail").collect()


def test_default_offset(bounds):
    got = offsets.default_offset(bounds.where("part = 0"), False).unionByName(offsets.default_offset(bounds.where("part = 0"), True))
    assert sorted(row.off for row in got.collect()) == [100, 200]


def test_next_offset_skips_gaps_and_never_goes_back(make, make_log):
    log = make_log([("t", 0, 5), ("t", 0, 9), ("t", 1, 5)])
    saved = make([("t", 1, "j", 40)], SAVED)
    assert rows_of(offsets.next_offset(log, saved)) == [("t", 0, 10), ("t", 1, 40)]


def test_offset_at_time(make):
    day = lambda n: dt.datetime(2024, 1, n)
    log = make([("t", 0, 1, day(1)), ("t", 0, 2, day(3)), ("t", 1, 7, day(1))], "topic STRING, part INT, off BIGINT, ts TIMESTAMP_NTZ")
    at = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    assert rows_of(offsets.offset_at_time(log, at)) == [("t", 0, 2), ("t", 1, 8)]


def test_lag(bounds, saved):
    got = by_part(offsets.offset_lag(bounds, saved, max_behind=100), "lag", "too_far")
    assert got[2] == (100, False) and got[1] == (101, True) and got[4] == (-1, False)
    assert 0 not in got


def test_inflight_offsets(make_log):
    emitted = make_log([("t", 0, 1), ("t", 0, 2), ("t", 0, 2), ("t", 0, 5), ("t", 1, 3)])
    finished = make_log([("t", 0, 1), ("t", 0, 5), ("t", 0, 5), ("t", 1, 3), ("t", 1, 99)])
    assert rows_of(offsets.inflight_offsets(emitted, finished)) == [("t", 0, 1, 2), ("t", 1, 0, 4)]
