"""Runs that save their positions, and runs that meet."""

import pytest
from conftest import rows_of

from ferrylog.plans.mirror import run_mirror
from ferrylog.settings import MirrorSettings
from ferrylog.sources import table
from ferrylog.sources.checkpoints import CheckpointStore, StaleWriter

SETTINGS = MirrorSettings(source="t", target="copy_", client_id="job")
COMMITS = "topic STRING, part INT, seq BIGINT, off BIGINT"


def test_of_two_writers_on_one_snapshot_the_second_fails_and_nothing_goes_back(make, spark, folder):
    store = CheckpointStore(folder)
    assert store.commit(make([("t", 0, 1, 50)], COMMITS), -1, job_id="job", owner="a") == 0
    begun = store.latest(spark)
    assert store.commit(make([("t", 0, 2, 90)], COMMITS), begun, job_id="job", owner="b") == 1
    with pytest.raises(StaleWriter):
        store.commit(make([("t", 0, 3, 60)], COMMITS), begun, job_id="job", owner="a")
    with pytest.raises(StaleWriter):
        store.claim(spark, 0, "a")
    assert rows_of(store.read(spark, store.latest(spark))) == [("t", 0, "job", 90)]
    # the owner of a number may redo it, as after a loss between claim and save
    assert store.commit(make([("t", 0, 2, 90), ("t", 1, 2, 7)], COMMITS), begun, job_id="job", owner="b") == 1
    assert rows_of(store.read(spark, 1)) == [("t", 0, "job", 90), ("t", 1, "job", 7)]


def test_runs_of_the_mirror_go_on_from_what_was_saved(make_log, spark, folder):
    store, out = CheckpointStore(f"{folder}/saved"), f"{folder}/out"
    log = make_log([("t", 0, off) for off in range(5)] + [("t", 1, 3), ("u", 0, 1)])
    assert run_mirror(log, store, out, SETTINGS, owner="one") == 0
    assert run_mirror(log, store, out, SETTINGS, owner="two") == 1  # nothing new
    more = make_log([("t", 0, off) for off in range(9)] + [("t", 1, 3), ("t", 2, 0)])
    assert run_mirror(more, store, out, SETTINGS, owner="one") == 2
    got = rows_of(table.read_batches(spark, out).select("batch_id", "topic", "part", "off"))
    first = [(0, "copy_t", 0, off) for off in range(5)] + [(0, "copy_t", 1, 3)]
    assert got == first + [(2, "copy_t", 0, off) for off in range(5, 9)] + [(2, "copy_t", 2, 0)]
    assert rows_of(store.read(spark, 2)) == [("t", 0, "job", 9), ("t", 1, "job", 4), ("t", 2, "job", 1)]


def test_a_run_that_meets_another_one_copies_nothing(make_log, spark, folder):
    store, out = CheckpointStore(f"{folder}/saved"), f"{folder}/out"
    log = make_log([("t", 0, off) for off in range(5)])
    store.claim(spark, 0, "other")
    with pytest.raises(StaleWriter):
        run_mirror(log, store, out, SETTINGS, owner="one")
    assert table.last_batch(spark, out) == -1
    # the other one goes on, as after a restart
    assert run_mirror(log, store, out, SETTINGS, owner="other") == 0
    assert table.read_batches(spark, out).count() == 5
