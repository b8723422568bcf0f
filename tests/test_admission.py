"""Token buckets: what each trigger takes, against a plain loop, and runs that are cut off."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from ferrylog.operators.segments import LAYOUT_SPAN
from ferrylog.sources import table
from ferrylog.streaming import admission
from ferrylog.streaming.admission import Admission, Bucket, ticks
from ferrylog.streaming.mirror import StreamMirror

SPAN = LAYOUT_SPAN


def plain(rows, bucket, every, starts=None):
    """Batches of (off, size) lists by filling buckets row by row."""
    at = sorted((off, size) for off, size in rows if off >= (starts or 0))
    batches, level, place, first = [], bucket.capacity, 0, True
    while place < len(at) or first:
        if not first:
            level = min(bucket.capacity, level + int(every * bucket.capacity / bucket.seconds))
        first, taken, full = False, [], level == bucket.capacity
        while place < len(at):
            size = at[place][1]
            if size <= level or full and not taken and size > bucket.capacity:
                alone = size > level
                taken.append(at[place])
                level -= size
                place += 1
                if alone:
                    break
            else:
                break
        batches.append((taken, level))
    return batches


def store(make, folder, spark, logs):
    rows = [(t, p, off, b"x" * size) for (t, p), offs in logs.items() for off, size in offs]
    table.write_log(make(rows, "topic STRING, part INT, off BIGINT, value BINARY"), folder, segments=True, value="value")
    return table.stored_log(spark, folder)


@pytest.fixture
def logs():
    r = random.Random(6)
    offs = sorted(r.sample(range(4 * SPAN), 40))
    return {
        ("t", 0): [(off, r.choice([0, 1, 7, 20, 50])) for off in offs],
        ("t", 1): [(SPAN - 2, 40), (SPAN - 1, 60), (SPAN, 0), (SPAN + 1, 0), (2 * SPAN, 99), (2 * SPAN + 1, 1)],  # full to the byte
        ("u", 0): [(3, 500), (4, 10), (5, 250), (6, 0), (SPAN * 9, 20)],  # rows larger than a bucket
        ("u", 1): [(0, 0), (1, 0)],
    }


@pytest.mark.parametrize("every", [60, 40])
def test_each_trigger_takes_what_a_plain_loop_takes(make, spark, folder, logs, every):
    bucket = Bucket(100, 60)
    starts = {("t", 0): logs["t", 0][12][0], ("u", 0): 4}
    stored = store(make, f"{folder}/log", spark, logs)
    table_of_starts = make([(*key, off) for key, off in starts.items()], "topic STRING, part INT, start_off BIGINT")
    admission = Admission(stored, f"{folder}/run", bucket, starts=table_of_starts)
    got = {}
    n = admission.run(spark, lambda rows, i: got.__setitem__(i, rows_of(rows.select("topic", "part", "off"))), clock=ticks(every))
    want = {key: plain(rows, bucket, every, starts.get(key)) for key, rows in logs.items()}
    assert n == max(map(len, want.values())) == len(got)
    for i in range(n):
        rows = [(*key, off) for key, batches in want.items() if i < len(batches) for off, _ in batches[i][0]]
        assert got[i] == sorted(rows, key=lambda row: tuple(map(str, row)))
    plans = {(r.topic, r.part, r.batch_id): r for r in admission.admitted(spark).collect()}
    for key, batches in want.items():
        for i, (taken, level) in enumerate(batches):
            plan = plans[*key, i]
            assert (plan.n, plan.bytes, plan.level) == (len(taken), sum(size for _, size in taken), level)


def test_bytes_of_a_partition_and_minute_stay_within_the_bucket(make, spark, folder, logs):
    """Without the bucket all of a partition would come in the first minute."""
    logs = {key: [(off, size) for off, size in rows if size <= 100] for key, rows in logs.items()}
    admission = Admission(store(make, f"{folder}/log", spark, logs), f"{folder}/run", Bucket(100, 60))
    admission.run(spark, clock=ticks(60))
    minutes = admission.admitted(spark).groupBy("topic", "part", (F.col("at") / 60e6).cast("int").alias("minute")).agg(F.sum("bytes").alias("bytes"))
    assert minutes.agg(F.max("bytes")).first()[0] <= 100
    assert minutes.where("topic = 't' AND part = 0 AND bytes > 0").count() > 4


def test_a_plan_opens_the_segment_only_in_which_a_level_runs_out(make, spark, folder):
    from test_manifest import spoil

    logs = {("t", 0): [(seg * SPAN + i, 10) for seg in range(6) for i in range(5)]}
    stored = store(make, f"{folder}/log", spark, logs)
    spoil(f"{folder}/log", ["t.0.2", "t.0.4"])
    admission = Admission(stored, f"{folder}/run", Bucket(120, 60))
    first = admission.plan(spark, 0, 0).first()
    assert (first.n, first.bytes, first.position) == (12, 120, 2 * SPAN + 2)
    second = admission.plan(spark, 1, int(60e6)).first()
    assert (second.n, second.from_off, second.position) == (12, 2 * SPAN + 2, 4 * SPAN + 4)


def test_a_batch_that_was_cut_off_is_redone_as_it_was_planned(make, spark, folder, logs):
    stored = store(make, f"{folder}/log", spark, logs)

    class CutOff(Exception):
        pass

    def run(root, fail_at=None):
        mirror = StreamMirror(root=f"{root}/mirror", target="copy_", key="sequence", cycle=7)

        def copy(rows, batch_id):
            if batch_id == fail_at:
                raise CutOff
            mirror.copy(rows, batch_id)

        Admission(stored, f"{root}/run", Bucket(300, 60)).run(spark, copy, clock=ticks(60))
        return rows_of(mirror.mirrored(spark).select("topic", "part", "off", "key", "batch_id"))

    with pytest.raises(CutOff):
        run(f"{folder}/a", fail_at=1)
    assert run(f"{folder}/a") == run(f"{folder}/b")


@pytest.mark.parametrize("every, ahead, at_once", [(60, 1024, 1 << 20), (40, 3, 25)])
def test_rounds_of_triggers_are_planned_and_copied_as_a_plain_loop_takes_them(make, spark, folder, logs, every, ahead, at_once, monkeypatch):
    """Rounds that end with the log, by their length, or by the rows they look at; there was a plan and a copy for each trigger."""
    monkeypatch.setattr(admission, "AHEAD_ROWS", at_once)
    bucket, starts = Bucket(100, 60), {("t", 0): logs["t", 0][12][0], ("u", 0): 4}
    table_of_starts = make([(*key, off) for key, off in starts.items()], "topic STRING, part INT, start_off BIGINT")
    mirror, rounds = StreamMirror(root=f"{folder}/mirror", target="copy_", key="sequence", cycle=7), []
    limited = Admission(store(make, f"{folder}/log", spark, logs), f"{folder}/run", bucket, starts=table_of_starts)

    def copy(rows, first):
        rounds.append(first)
        mirror.copy(rows, first)

    n = limited.run_ahead(spark, copy, clock=ticks(every), ahead=ahead)
    want = {key: plain(rows, bucket, every, starts.get(key)) for key, rows in logs.items()}
    assert n == max(map(len, want.values())) and rounds[0] == 0 and (len(rounds) == 1 if ahead > n else 1 < len(rounds) < 10)
    plans = {(r.topic, r.part, r.batch_id): r for r in limited.admitted(spark).collect()}
    assert len(plans) == n * len(logs)
    for key, batches in want.items():
        for i, (taken, level) in enumerate(batches):
            plan = plans[*key, i]
            assert (plan.n, plan.bytes, plan.level) == (len(taken), sum(size for _, size in taken), level)
    rows = [
        (f"copy_{key[0]}", key[1], off, (nth - 1) % 7 + 1, i)
        for key, batches in want.items()
        for nth, (i, off) in enumerate(((i, off) for i, (taken, _) in enumerate(batches) for off, _ in taken), 1)
    ]
    got = mirror.mirrored(spark).select("topic", "part", "off", F.col("key").cast("int"), F.col("batch_id").cast("int"))
    assert rows_of(got) == sorted(rows, key=lambda row: tuple(map(str, row)))


def test_a_trigger_that_takes_more_than_a_round_looks_at_is_planned_alone(make, spark, folder, monkeypatch):
    monkeypatch.setattr(admission, "AHEAD_ROWS", 3)
    stored = store(make, f"{folder}/log", spark, {("t", 0): [(i, 10) for i in range(12)]})
    limited = Admission(stored, f"{folder}/run", Bucket(50, 60))
    assert limited.run_ahead(spark, clock=ticks(60)) == 3
    assert [r.n for r in limited.admitted(spark).orderBy("batch_id").collect()] == [5, 5, 2]


def test_a_round_that_was_cut_off_is_redone_as_it_was_planned(make, spark, folder):
    stored = store(make, f"{folder}/log", spark, {("t", 0): [(i, 10) for i in range(35)]})
    mirror = StreamMirror(root=f"{folder}/mirror", target="copy_", key="sequence", cycle=100)
    limited = Admission(stored, f"{folder}/run", Bucket(50, 60))

    class CutOff(Exception):
        pass

    def copy(rows, first):
        mirror.copy(rows, first)
        if first == 4:
            raise CutOff

    with pytest.raises(CutOff):
        limited.run_ahead(spark, copy, clock=ticks(60), ahead=4)
    assert limited.run_ahead(spark, mirror.copy, clock=ticks(60), ahead=2) == 7
    got = mirror.mirrored(spark).select("off", F.col("key").cast("int"), F.col("batch_id").cast("int"))
    assert sorted(map(tuple, got.collect())) == [(i, i + 1, i // 5) for i in range(35)]


def test_a_log_that_has_grown_goes_on_where_the_last_plan_ended(make, spark, folder):
    rows = lambda offs: make([("t", 0, off, b"x" * 10) for off in offs], "topic STRING, part INT, off BIGINT, value BINARY")
    table.write_log(rows(range(8)), f"{folder}/log", segments=True, value="value")
    got = []
    take = lambda batch, _: got.append(sorted(r.off for r in batch.collect()))
    Admission(table.stored_log(spark, f"{folder}/log"), f"{folder}/run", Bucket(50, 60)).run(spark, take, clock=ticks(60))
    assert got == [[0, 1, 2, 3, 4], [5, 6, 7]]
    table.write_log(rows([*range(8, 12), SPAN]), f"{folder}/log", mode="append", segments=True, value="value")
    got.clear()
    Admission(table.stored_log(spark, f"{folder}/log"), f"{folder}/run", Bucket(50, 60)).run(spark, take, clock=ticks(60))
    # the last batch is redone, as it may not have been copied
    assert got == [[5, 6, 7], [8, 9, 10, 11, SPAN]]


def test_an_empty_log(make, spark, folder):
    table.write_log(make([], "topic STRING, part INT, off BIGINT, value BINARY"), f"{folder}/log", segments=True, value="value")
    stored = table.stored_log(spark, f"{folder}/log", "off BIGINT, value BINARY, topic STRING, part INT, seg STRING")
    assert Admission(stored, f"{folder}/run").run(spark, clock=ticks(60)) == 1
