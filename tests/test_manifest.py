"""Manifests of stored logs, and queries that answer from them without opening files."""

from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from ferrylog.operators import log as log_ops, offsets, replay
from ferrylog.operators.segments import LAYOUT_SPAN, StoredLog, from_positions
from ferrylog.sources import table

SPAN = LAYOUT_SPAN
SCHEMA = "topic STRING, part INT, off BIGINT, value BINARY, ts TIMESTAMP_NTZ"


def build(make, rows):
    """(topic, part, off, minute) rows; the value is as long as the offset's last digit."""
    made = make([(t, p, off, b"x" * (off % 10), minute) for t, p, off, minute in rows], "topic STRING, part INT, off BIGINT, value BINARY, m INT")
    return made.select("topic", "part", "off", "value", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,m,0)").alias("ts"))


def spread(parts=("t",)):
    return [(t, 0, seg * SPAN + i, seg * 100 + i) for t in parts for seg in range(4) for i in (5, 6, 9)]


def spoil(folder, keep):
    """Cut off all files but those of the segments to keep; reading one of them fails."""
    gone = 0
    for file in Path(folder).rglob("*.parquet"):
        if "_manifest" not in str(file) and not any(f"seg={seg}/" in str(file) for seg in keep):
            file.write_bytes(b"PAR1")
            crc = file.with_name(f".{file.name}.crc")
            crc.unlink(missing_ok=True)
            gone += 1
    return gone


def at(minute):
    return F.expr(f"timestamp_ntz '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,{minute},0)")


def test_a_manifest_has_the_facts_of_each_segment(spark, make, folder):
    log = build(make, spread())
    table.write_log(log, folder, segments=True, ts="ts", value="value")
    stored = table.stored_log(spark, folder)
    got = rows_of(stored.segments.select("seg", "n", "first_off", "last_off", F.minute("min_ts"), "bytes"))
    want = []
    for s in range(4):
        offs = [s * SPAN + i for i in (5, 6, 9)]
        want.append((f"t.0.{s}", 3, offs[0], offs[-1], (s * 100 + 5) % 60, sum(o % 10 for o in offs)))
    assert got == want
    assert rows_of(offsets.offset_bounds(stored)) == rows_of(offsets.offset_bounds(stored.rows))


def test_bounds_times_and_starts_open_no_file_that_does_not_matter(spark, make, folder):
    table.write_log(build(make, spread(("t", "u"))), folder, segments=True, ts="ts", value="value")
    stored = table.stored_log(spark, folder)
    spoil(folder, ["t.0.2", "t.0.3", "u.0.3"])
    assert rows_of(offsets.offset_bounds(stored)) == [("t", 0, 5, 3 * SPAN + 10, 12, 3 * SPAN + 10 - 5 - 12), ("u", 0, 5, 3 * SPAN + 10, 12, 3 * SPAN + 10 - 5 - 12)]
    # the time lies between segments: none is opened
    assert {r.off for r in offsets.offset_at_time(stored, at(150)).collect()} == {2 * SPAN + 5}
    assert {r.off for r in offsets.offset_at_time(stored, at(9999)).collect()} == {3 * SPAN + 10}
    # within a segment: that one alone
    only_t = StoredLog(stored.rows, stored.segments.where("topic = 't'"))
    assert [r.off for r in offsets.offset_at_time(only_t, at(206)).collect()] == [2 * SPAN + 6]
    starts = make([("t", 0, 2 * SPAN + 6), ("u", 0, 2 * SPAN + 10)], "topic STRING, part INT, start_off BIGINT")
    got = rows_of(log_ops.scan_from(stored, starts).select("topic", "off"))
    # the last offset of a segment is known, so a start behind it skips it
    assert got == [("t", s * SPAN + i) for s in (2, 3) for i in (5, 6, 9) if (s, i) != (2, 5)] + [("u", 3 * SPAN + i) for i in (5, 6, 9)]
    with pytest.raises(Exception, match="(?i)parquet|file"):
        stored.rows.count()


def test_times_that_go_back_along_the_offsets(make, spark, folder):
    rows = [("t", 0, 0, 50), ("t", 0, 1, 90), ("t", 0, 2, 10), ("t", 0, SPAN, 20), ("t", 0, SPAN + 1, 95), ("t", 0, 2 * SPAN, 5)]
    table.write_log(build(make, rows), folder, segments=True, ts="ts")
    stored = table.stored_log(spark, folder)
    for minute in (0, 5, 10, 20, 50, 51, 90, 91, 95, 96):
        want = rows_of(offsets.offset_at_time(stored.rows, at(minute)))
        assert rows_of(offsets.offset_at_time(stored, at(minute))) == want


def test_appended_rows_and_appends_that_were_cut_off(spark, make, folder):
    table.write_log(build(make, spread()), folder, segments=True, ts="ts", value="value")
    more = build(make, [("t", 0, 3 * SPAN + 20, 400), ("t", 0, 5 * SPAN, 500), ("v", 1, 7, 1)])
    table.write_log(more, folder, mode="append", segments=True, ts="ts", value="value")
    stored = table.stored_log(spark, folder)
    assert isinstance(stored, StoredLog)
    assert rows_of(offsets.offset_bounds(stored)) == rows_of(offsets.offset_bounds(stored.rows))
    assert rows_of(stored.segments.where("seg = 't.0.3'").select("n", "last_off")) == [(4, 3 * SPAN + 20)]
    # rows that were written without their manifest, as by a run that ended in between
    Path(folder, "_manifest", "open").mkdir()
    table.write_log(build(make, [("t", 0, 9 * SPAN, 1)]), f"{folder}-x")
    plain = table.stored_log(spark, folder)
    assert not isinstance(plain, StoredLog)
    assert rows_of(offsets.offset_bounds(plain)) == rows_of(offsets.offset_bounds(stored))
    table.write_manifest(table.read_log(spark, folder), folder, ts="ts", value="value")
    assert isinstance(table.stored_log(spark, folder), StoredLog)


def test_a_manifest_without_all_times_is_not_asked_for_them(spark, make, folder):
    table.write_log(build(make, spread()), folder, segments=True, ts="ts")
    table.write_log(build(make, [("t", 0, 4 * SPAN, 500)]), folder, mode="append", segments=True)
    stored = table.stored_log(spark, folder)
    assert rows_of(offsets.offset_at_time(stored, at(450)).select("off")) == [(4 * SPAN,)]


def test_an_empty_log_and_partitions_without_rows(spark, make, folder):
    table.write_log(build(make, spread()).where("off < 0"), folder, segments=True, ts="ts", value="value")
    stored = table.stored_log(spark, folder, f"off BIGINT, value BINARY, ts TIMESTAMP_NTZ, topic STRING, part INT, seg STRING")
    bounds = offsets.offset_bounds(stored)
    assert bounds.count() == 0
    known = make([("t", 0), ("t", 1)], "topic STRING, part INT")
    starts = offsets.resolve_start(bounds, make([], "topic STRING, part INT, committed BIGINT"))
    got = rows_of(replay.emit_state(stored, starts, bounds, known))
    assert got == [("t", 0, None, replay.NOTHING), ("t", 1, None, replay.NOTHING)]
    assert from_positions(stored, starts, "start_off").count() == 0
