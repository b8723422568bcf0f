import datetime as dt

from conftest import rows_of

from ferrylog.operators import monitor

DAY = dt.datetime(2024, 1, 1)


def timed(make, rows):
    return make([(t, p, off, b"x" * n, DAY + dt.timedelta(seconds=s)) for t, p, off, n, s in rows],
                "topic STRING, part INT, off BIGINT, value BINARY, ts TIMESTAMP_NTZ")


def test_volume_is_over_the_limit_only_above_it(make):
    log = timed(make, [("t", 0, 0, 60, 0), ("t", 0, 1, 40, 59), ("t", 0, 2, 101, 60)])
    got = monitor.payload_volume(log, width="60 seconds", limit=100)
    assert [row[3:] for row in rows_of(got)] == [(100, False), (101, True)]


def test_gaps_start_at_the_last_row(make):
    log = timed(make, [("t", 0, 0, 1, 0), ("t", 0, 5, 1, 1201), ("t", 0, 6, 1, 2401), ("u", 0, 0, 1, 9000)])
    for span in (1, 2, 1 << 14):
        assert rows_of(monitor.idle_gaps(log, limit_seconds=1200, span=span)) == [("t", 0, 5, 1201)]


def test_error_rollup(make):
    fetches = make([(0, 1, 0), (0, 2, 1), (0, 3, 1), (1, 1, 77)], "part INT, seq BIGINT, error_code INT")
    assert rows_of(monitor.fetch_error_rollup(fetches)) == [
        (0, "NO_ERROR", "ok", 1), (0, "OFFSET_OUT_OF_RANGE", "reset", 2), (1, "UNKNOWN", "fail", 1)
    ]
    strict = monitor.fetch_error_rollup(fetches, reset_allowed=False)
    assert (0, "OFFSET_OUT_OF_RANGE", "fail", 2) in rows_of(strict)


def test_streaks_end_with_a_success(make):
    codes = [3, 3, 0, 5, 1, 2, 0, 0, 9, 9, 9, 9]
    fetches = make([(0, seq, code) for seq, code in enumerate(codes)] + [(1, 0, 4)], "part INT, seq BIGINT, error_code INT")
    for span in (1, 3, 1 << 14):
        assert rows_of(monitor.error_streaks(fetches, tolerated=2, span=span)) == [(0, 3, 5, 3), (0, 8, 11, 4)]


def test_one_position_per_window(make):
    commits = make([("t", 0, 1, 10, DAY), ("t", 0, 2, 5, DAY + dt.timedelta(seconds=30)), ("t", 0, 3, 40, DAY + dt.timedelta(seconds=61))],
                   "topic STRING, part INT, seq BIGINT, off BIGINT, ts TIMESTAMP_NTZ")
    assert [row[3] for row in rows_of(monitor.commit_cadence(commits, width="60 seconds"))] == [5, 40]
