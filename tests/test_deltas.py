"""Keyed tables that grow by deltas."""

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from ferrylog.operators import metadata
from ferrylog.sources import table
from ferrylog.sources.checkpoints import CheckpointStore
from ferrylog.sources.deltas import DeltaTable
from ferrylog.staging import children, delete

SCHEMA = "k STRING, v INT, w STRING"
CHANGES = f"{SCHEMA}, seq INT, off BOOLEAN"


@pytest.fixture
def deltas(folder):
    return DeltaTable(folder, SCHEMA, ("k",))


def write(deltas, make, rows, number):
    deltas.write(make(rows, CHANGES), number, order="seq", gone=F.col("off"))


def three(deltas, make):
    write(deltas, make, [("a", 1, "x", 1, False), ("a", 2, "y", 2, False), ("b", 5, None, 1, False), (None, 7, "n", 1, None)], 0)
    write(deltas, make, [("b", 6, "z", 1, False), ("c", 9, "c", 1, False), ("c", 9, "c", 2, True)], 1)
    write(deltas, make, [("a", 3, "x", 9, True), ("d", None, None, 1, False)], 2)


STATES = {
    -1: [],
    0: [("a", 2, "y"), ("b", 5, None), (None, 7, "n")],
    1: [("a", 2, "y"), ("b", 6, "z"), (None, 7, "n")],
    2: [("b", 6, "z"), ("d", None, None), (None, 7, "n")],
}


def same(deltas, spark, numbers=STATES):
    for n in numbers:
        assert rows_of(deltas.read(spark, n)) == sorted(STATES[n], key=lambda row: tuple(map(str, row)))


def test_every_number_reads_the_same_before_and_after_compaction(spark, make, deltas):
    assert deltas.latest(spark) == -1 and rows_of(deltas.read(spark)) == []
    three(deltas, make)
    same(deltas, spark)
    assert deltas.compact(spark, 1) == 1
    same(deltas, spark)
    assert deltas.compact(spark) == 2 and deltas.compact(spark) == 2
    same(deltas, spark)
    assert "Exchange" not in plan_of(deltas.read(spark))  # a base is read as it is


def test_a_delta_is_as_small_as_the_change(spark, make, deltas, folder):
    three(deltas, make)
    sizes = [spark.read.parquet(table.batch_path(f"{folder}/deltas", n)).count() for n in range(3)]
    assert sizes == [3, 2, 2]


def test_a_delta_may_be_redone_until_a_base_holds_it(spark, make, deltas):
    three(deltas, make)
    write(deltas, make, [("a", 3, "x", 9, True), ("d", None, None, 1, False)], 2)
    same(deltas, spark)
    deltas.compact(spark, 1)
    with pytest.raises(ValueError, match="part of a base"):
        write(deltas, make, [("q", 1, "q", 1, False)], 1)
    write(deltas, make, [], 2)
    assert rows_of(deltas.read(spark)) == sorted(STATES[1], key=lambda row: tuple(map(str, row)))


def test_what_was_cut_off_is_not_seen(spark, make, deltas, folder):
    three(deltas, make)
    deltas.compact(spark, 1)
    delete(spark, f"{folder}/bases/batch_id=1/_SUCCESS")
    same(deltas, spark)
    delete(spark, f"{folder}/deltas/batch_id=2/_SUCCESS")
    assert deltas.latest(spark) == 1
    same(deltas, spark, [0, 1])


def test_forgotten_numbers_are_refused(spark, make, deltas, folder):
    three(deltas, make)
    assert deltas.forget(spark, 2) == 0
    deltas.compact(spark, 1)
    assert deltas.forget(spark, 2) == 1
    assert children(spark, f"{folder}/deltas") == ["batch_id=2"]
    same(deltas, spark, [1, 2])
    with pytest.raises(ValueError, match="not kept"):
        deltas.read(spark, 0)


def test_equal_orders_give_the_highest_values(spark, make, deltas):
    rows = [("a", 1, "x", 1, False), ("a", 3, "b", 1, False), ("a", 3, "a", 1, False)]
    write(deltas, make, rows, 0)
    deltas.write(make(rows, CHANGES), 1)
    assert rows_of(deltas.read(spark, 0)) == rows_of(deltas.read(spark, 1)) == [("a", 3, "b")]


def test_saved_positions_are_compacted_on_the_way(spark, make, folder):
    store = CheckpointStore(folder, compact_every=2)
    for n in range(6):
        store.save(make([("t", n % 3, 1, 10 * n), ("t", n % 3, 0, 99)], "topic STRING, part INT, seq BIGINT, off BIGINT"), n, job_id="job")
    assert sorted(children(spark, f"{folder}/bases")) == ["batch_id=1", "batch_id=3"]
    assert rows_of(store.read(spark, 5)) == [("t", 0, "job", 30), ("t", 1, "job", 40), ("t", 2, "job", 50)]
    assert rows_of(store.read(spark, 2)) == [("t", 0, "job", 0), ("t", 1, "job", 10), ("t", 2, "job", 20)]


def test_registry_after_deltas_equals_registry_of_all_events(spark, make, folder):
    events = make(
        [(1, "t", 0, 1, "register"), (1, "t", 1, 1, "register"), (1, "t", 0, 2, "unregister"), (2, "t", 0, 3, "register"),
         (1, "t", 0, 5, "register"), (2, "t", 0, 4, "unregister")],
        "broker_id INT, topic STRING, part INT, seq BIGINT, action STRING",
    )
    registry = metadata.registry(folder, compact_every=1)
    for n in range(3):
        metadata.register(registry, events.where(F.expr(f"seq div 2 = {n}")), n)
    got = rows_of(metadata.held_partitions(registry.read(spark)))
    assert got == rows_of(metadata.broker_partitions(events)) == [(1, "t", "0,1")]
