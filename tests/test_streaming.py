"""Streams against their batch twins, over restarts, repeated batches and late rows."""

import datetime as dt
import time
from collections import Counter

import pytest
from conftest import rows_of
from pyspark.errors import StreamingQueryException

from ferrylog.operators import monitor
from ferrylog.plans import mirror
from ferrylog.sources import table
from ferrylog.staging import app_folder, children
from ferrylog.streaming.idle import activity_sessions, idle_alarms
from ferrylog.streaming.metadata import Refreshing, with_leaders
from ferrylog.streaming.mirror import StreamMirror
from ferrylog.streaming.replay import ReplayFromLog, replay_stream, tagged
from ferrylog.streaming.runs import late_rows, run_available
from ferrylog.streaming.throttle import kept_limit, stored_bytes, throttled_stream
from ferrylog.streaming.volume import volume_stream

SCHEMA = "off BIGINT, value BINARY, topic STRING, part INT"
TIMED = "off BIGINT, value BINARY, ts TIMESTAMP, topic STRING, part INT"
FAILED = "topic STRING, part INT, off BIGINT"
START = dt.datetime(2024, 1, 1)


def arrive(make_log, feed, rows):
    table.write_log(make_log(rows), feed, mode="append")


def offsets(frame):
    return rows_of(frame.select("topic", "part", "off"))


def test_mirror_goes_on_from_its_checkpoint(spark, make, make_log, folder):
    feed, copy = f"{folder}/feed", StreamMirror(f"{folder}/copy", "sync_", key="sequence", cycle=10)
    first = [("t", 0, off) for off in range(0, 40) if off % 5] + [("u", 1, off) for off in range(7)]
    second = [("t", 0, off) for off in range(40, 70) if off % 5] + [("t", 2, 3)]
    arrive(make_log, feed, first)
    copy.run(table.stream_log(spark, feed, SCHEMA))
    copy.run(table.stream_log(spark, feed, SCHEMA))
    assert copy.mirrored(spark).count() == len(first)
    arrive(make_log, feed, second)
    copy.run(table.stream_log(spark, feed, SCHEMA))

    nothing = make([], "topic STRING, part INT, committed BIGINT")
    twin = mirror.mirror_batch(make_log(first + second), nothing, target="sync_", key="sequence", batch_rows=10)
    columns = ["topic", "part", "off", "key", "value"]
    assert rows_of(copy.mirrored(spark).select(columns)) == rows_of(twin.select(columns))
    assert rows_of(copy.positions(spark)) == [("t", 0, 70), ("t", 2, 4), ("u", 1, 7)]


def test_mirror_takes_many_small_batches(spark, make_log, folder):
    feed, copy = f"{folder}/feed", StreamMirror(f"{folder}/copy", "t", key="sequence", cycle=10)
    for at in range(0, 40, 10):
        arrive(make_log, feed, [("t", 0, off) for off in range(at, at + 10)])
    copy.run(table.stream_log(spark, feed, SCHEMA, bytes_per_trigger=1))
    got = copy.mirrored(spark).orderBy("off").collect()
    assert [row.key for row in got] == [str(n % 10 + 1) for n in range(40)]
    assert len({row.batch_id for row in got}) == 4


def test_mirror_batch_done_twice_adds_nothing(spark, make_log, folder):
    copy = StreamMirror(folder, "t", key="sequence")
    one, two = make_log([("t", 0, 1), ("t", 0, 2)]), make_log([("t", 0, 5)])
    for batch_id, rows in ((0, one), (1, two), (1, two)):
        copy.copy(rows, batch_id)
    assert offsets(copy.mirrored(spark)) == [("t", 0, 1), ("t", 0, 2), ("t", 0, 5)]
    assert [row.key for row in copy.mirrored(spark).orderBy("off").collect()] == ["1", "2", "3"]
    assert rows_of(copy.positions(spark)) == [("t", 0, 6)]


def test_mirror_copies_a_partition_that_has_no_start(spark, make, make_log, folder):
    starts = make([("t", 0, 3)], "topic STRING, part INT, start_off BIGINT")
    copy = StreamMirror(folder, "t", starts=starts)
    copy.copy(make_log([("t", 0, off) for off in range(6)]), 0)
    copy.copy(make_log([("t", 1, off) for off in range(4)]), 1)
    assert [row[1:] for row in offsets(copy.mirrored(spark))] == [(0, 3), (0, 4), (0, 5), (1, 0), (1, 1), (1, 2), (1, 3)]
    assert rows_of(copy.positions(spark)) == [("t", 0, 6), ("t", 1, 4)]


def test_staged_folders_of_a_micro_batch_are_deleted(spark, make_log, folder):
    copy = StreamMirror(folder, "t", key="sequence")
    copy.copy(make_log([("t", 0, 0)]), 0)
    before = len(children(spark, app_folder(spark)))
    for batch_id in range(1, 4):
        copy.copy(make_log([("t", 0, batch_id)]), batch_id)
    assert len(children(spark, app_folder(spark))) == before


def test_batches_that_are_not_complete_are_not_read(spark, make_log, folder):
    copy = StreamMirror(folder, "t")
    copy.copy(make_log([("t", 0, 0)]), 0)
    make_log([("t", 0, 1)]).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        table.batch_path(copy.data, 1)
    )
    assert offsets(copy.mirrored(spark)) == [("t", 0, 0)]


def test_mirror_drops_rows_below_the_start(spark, make, make_log, folder):
    starts = make([("t", 0, 3)], "topic STRING, part INT, start_off BIGINT")
    copy = StreamMirror(folder, "t", starts=starts, cache=True)
    copy.copy(make_log([("t", 0, off) for off in range(6)]), 0)
    assert offsets(copy.mirrored(spark)) == [("t", 0, 3), ("t", 0, 4), ("t", 0, 5)]


def test_a_source_that_goes_back_is_refused_when_counting(spark, make_log, folder):
    feed = f"{folder}/feed"
    arrive(make_log, feed, [("t", 0, 5)])
    counting, keeping = (StreamMirror(f"{folder}/{key}", "t", key=key) for key in ("sequence", "keep"))
    counting.run(table.stream_log(spark, feed, SCHEMA))
    keeping.run(table.stream_log(spark, feed, SCHEMA))
    arrive(make_log, feed, [("t", 0, 1)])
    with pytest.raises(StreamingQueryException):
        counting.run(table.stream_log(spark, feed, SCHEMA))
    keeping.run(table.stream_log(spark, feed, SCHEMA))
    assert keeping.mirrored(spark).count() == 2


def make_taken(spark, rows):
    return spark.createDataFrame(rows, "batch_id BIGINT, topic STRING, part INT, n BIGINT, bytes BIGINT, file STRING, file_bytes BIGINT")


def test_throttle_takes_whole_files_up_to_the_limit(spark, make_log, folder):
    feed = f"{folder}/feed"
    for at in range(4):
        arrive(make_log, feed, [("t", 0, at)])
    size = stored_bytes(spark, feed) // 4
    got = rows_of(throttled_stream(spark, feed, SCHEMA, f"{folder}/run", bytes_per_trigger=2 * size + 1))
    assert len({row[0] for row in got}) >= 2 and max(Counter(row[0] for row in got).values()) <= 2
    assert sum(row[3] for row in got) == 4 and sum(row[4] for row in got) == 8
    taken = make_taken(spark, got)
    assert {row.kept_limit for row in kept_limit(taken, 2 * size + 1).collect()} == {True}
    assert False in {row.kept_limit for row in kept_limit(taken, 1).collect()}


def timed(make, rows):
    return make([(off, b"x" * 10, START + dt.timedelta(minutes=m), t, p) for t, p, off, m in rows], TIMED)


def test_volume_stream_equals_batch_and_counts_late_rows(spark, make, folder):
    feed = f"{folder}/feed"
    on_time = [("t", 0, off, off) for off in range(100)]
    table.write_log(timed(make, on_time), feed)
    out = {}

    def keep(batch, _):
        for row in batch.collect():
            out[row.win_start] = row.bytes

    def run():
        stream = volume_stream(table.stream_log(spark, feed, TIMED), width="10 minutes", late="20 minutes")
        return run_available(stream, keep, f"{folder}/checkpoint", mode="update")

    assert late_rows(run()) == 0
    twin = monitor.payload_volume(timed(make, on_time), width="10 minutes")
    assert out == {row.win_start: row.bytes for row in twin.collect()}
    table.write_log(timed(make, [("t", 0, 100, 1), ("t", 0, 101, 99)]), feed, mode="append")
    before = dict(out)
    assert late_rows(run()) == 1
    assert sum(out.values()) == sum(before.values()) + 10


def test_sessions_stream_equals_batch_for_closed_spans(spark, make, folder):
    feed = f"{folder}/feed"
    minutes = [0, 1, 2, 60, 61, 200, 201]
    log = timed(make, [("t", 0, n, m) for n, m in enumerate(minutes)])
    table.write_log(log, feed)
    twin = rows_of(activity_sessions(log, gap="30 minutes"))
    assert [row[4] for row in twin] == [3, 2, 2]
    out = []
    stream = activity_sessions(table.stream_log(spark, feed, TIMED), gap="30 minutes", late="1 minute")
    run_available(stream, lambda batch, _: out.extend(map(tuple, batch.collect())), f"{folder}/checkpoint")
    assert sorted(out) == twin[:2]


def test_idle_alarm_by_event_time(spark, make, folder):
    feed, out = f"{folder}/feed", []

    def run():
        stream = idle_alarms(table.stream_log(spark, feed, TIMED), limit_seconds=1200, event_time=True, late="0 seconds")
        run_available(stream, lambda batch, _: out.extend(map(tuple, batch.collect())), f"{folder}/checkpoint")

    table.write_log(timed(make, [("t", 0, 0, 0), ("t", 0, 1, 5), ("u", 0, 0, 6)]), feed)
    run()
    assert out == []
    table.write_log(timed(make, [("u", 0, 1, 40)]), feed, mode="append")
    run()
    table.write_log(timed(make, [("u", 0, 2, 41)]), feed, mode="append")
    run()
    assert [(topic, part, ms) for topic, part, _, ms in out if topic == "t"] == [("t", 0, 1_200_000)]


def test_idle_alarm_by_processing_time(spark, make, folder):
    feed, out = f"{folder}/feed", []
    table.write_log(timed(make, [("t", 0, 0, 0), ("t", 1, 0, 0)]), feed)
    stream = idle_alarms(table.stream_log(spark, feed, TIMED), limit_seconds=1)
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: out.extend(map(tuple, batch.collect())))
        .outputMode("update")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(processingTime="1 second")
        .start()
    )
    try:
        until = time.monotonic() + 60
        while len(out) < 2 and time.monotonic() < until:
            time.sleep(0.5)
    finally:
        query.stop()
    assert sorted((topic, part) for topic, part, _, _ in out) == [("t", 0), ("t", 1)]


@pytest.mark.parametrize("form", ["state", "log"])
def test_failures_are_replayed_even_when_they_come_later_or_earlier(spark, make, make_log, folder, form):
    feed, failures = f"{folder}/feed", f"{folder}/failed"
    reread = ReplayFromLog(f"{folder}/run", lambda session: table.read_log(session, feed, SCHEMA))

    def keep(batch, batch_id):
        table.write_batch(batch, f"{folder}/run/out", batch_id)

    def fail(rows):
        make(rows, FAILED).write.mode("append").parquet(failures)

    def run():
        log, failed = table.stream_log(spark, feed, SCHEMA), spark.readStream.schema(FAILED).parquet(failures)
        if form == "state":
            run_available(replay_stream(log, failed), keep, f"{folder}/run/checkpoint")
        else:
            run_available(tagged(log, failed), reread.copy, f"{folder}/run/checkpoint")

    arrive(make_log, feed, [("t", 0, off) for off in range(10)])
    fail([("t", 0, 3), ("t", 0, 3), ("t", 0, 12)])
    run()
    fail([("t", 0, 7)])
    arrive(make_log, feed, [("t", 0, off) for off in range(10, 14)])
    run()
    out = table.read_batches(spark, f"{folder}/run/out")
    assert offsets(out.where("NOT replayed")) == sorted((("t", 0, off) for off in range(14)), key=lambda row: tuple(map(str, row)))
    assert offsets(out.where("replayed")) == [("t", 0, 12), ("t", 0, 3), ("t", 0, 7)]
    assert {bytes(row.value) for row in out.where("off = 7").collect()} == {b"v7"}


def test_metadata_is_read_again_when_old(spark, make, make_log):
    hosts = iter(["first", "second", "third"])
    load = lambda session: make([("t", 0, next(hosts), 1)], "topic STRING, part INT, host STRING, port INT")
    log = make_log([("t", 0, 1), ("t", 1, 1)])

    always = Refreshing(load, seconds=0)
    assert [with_leaders(log, always.current(spark)).where("part = 0").first().host for _ in range(2)] == ["first", "second"]
    cached = Refreshing(load, seconds=3600)
    assert cached.current(spark) is cached.current(spark) and cached.loads == 1
    assert rows_of(with_leaders(log, cached.current(spark)).select("part", "host")) == [(0, "third"), (1, None)]


def test_replay_state_shrinks_behind_the_watermark_and_stays_on_the_jvm(spark, make, folder):
    feed, failures = f"{folder}/feed", f"{folder}/failed"
    schema = f"{FAILED}, failed_at TIMESTAMP"
    at = lambda minutes: START + dt.timedelta(minutes=minutes)
    sizes, out = [], []

    def run():
        log, failed = table.stream_log(spark, feed, TIMED), spark.readStream.schema(schema).parquet(failures)
        stream = replay_stream(log, failed, ts="ts", keep="30 minutes", late="0 seconds")
        query = run_available(stream, lambda batch, _: out.extend(map(tuple, batch.collect())), f"{folder}/checkpoint")
        sizes.append(sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"]))
        assert "Python" not in query._jsq.explainInternal(False)

    table.write_log(timed(make, [("t", 0, off, off % 10) for off in range(500)]), feed)
    make([("t", 0, 3, at(9)), ("t", 0, 3, at(9)), ("t", 0, 4, at(300))], schema).write.parquet(failures)
    run()
    table.write_log(timed(make, [("t", 0, 1000, 400)]), feed, mode="append")
    make([("t", 0, 1000, at(401))], schema).write.mode("append").parquet(failures)
    run()
    table.write_log(timed(make, [("t", 0, 1001, 402)]), feed, mode="append")
    run()
    assert sorted(row[2] for row in out if row[4]) == [3, 1000]
    assert len([row for row in out if not row[4]]) == 502
    assert sizes[0] >= 500 and sizes[-1] < 20


def test_volume_query_keeps_rows_of_any_age(spark, make, folder, monkeypatch):
    from types import SimpleNamespace

    from ferrylog.plans import streams
    from ferrylog.plans.inputs import LOG_SCHEMA

    feed = f"{folder}/feed"
    days = [400, 399, 200, 100, 1, 0]  # newest files first
    for n, day in enumerate(days):
        row = (n, n, "x" * 10, START + dt.timedelta(days=day), "t", 0, "s")
        table.write_log(make([row], LOG_SCHEMA), feed, mode="append")
        time.sleep(0.02)
    monkeypatch.setattr(streams, "BYTES_PER_TRIGGER", 1)
    log = table.read_log(spark, feed, LOG_SCHEMA)
    inputs = SimpleNamespace(spark=spark, log_folder=lambda: feed, log=lambda: log)
    got = rows_of(streams.volume_stream(inputs).select("win_start", "bytes"))
    assert got == sorted((START + dt.timedelta(days=day), 10) for day in days)
    monkeypatch.setattr(streams, "_lateness", lambda log: "60 days")
    with pytest.raises(RuntimeError, match="dropped"):
        streams.volume_stream(inputs)


def test_streams_of_small_state_have_no_more_stores_than_cores(make, spark, folder):
    """A store is committed by every micro-batch; there were as many as the session has shuffle partitions."""
    rows = [("t", i % 2, i, b"x" * 10, dt.datetime(2024, 1, 1, 0, i)) for i in range(6)]
    table.write_log(make(rows, "topic STRING, part INT, off BIGINT, value BINARY, ts TIMESTAMP"), f"{folder}/log")
    schema = "off BIGINT, value BINARY, ts TIMESTAMP, topic STRING, part INT"
    got = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(cores + 20))
    try:
        stream = volume_stream(table.stream_log(spark, f"{folder}/log", schema), late="1 hour")
        run_available(stream, lambda batch, _: got.extend(batch.collect()), f"{folder}/checkpoint", mode="update", small_state=True)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(cores + 20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(r.bytes for r in got) == 60
    assert sum(name.isdigit() for name in children(spark, f"{folder}/checkpoint/state/0")) == cores
