"""Staged tables: scopes of threads, tables that outlive a scope, and lists that are broadcast by size."""

import threading

from conftest import plan_of

from ferrylog.staging import app_folder, children, scratch, small, stage
from ferrylog.streaming.metadata import Refreshing


def test_a_scope_deletes_what_its_own_thread_staged(spark):
    inside, over = threading.Event(), threading.Event()
    kept = []

    def other():
        inside.wait(60)
        kept.append(stage(spark.range(5), "main"))  # as a batch query beside a running stream
        over.set()

    thread = threading.Thread(target=other)
    thread.start()
    with scratch(spark):
        mine = stage(spark.range(3), "mine")
        inside.set()
        assert over.wait(60)
        assert mine.count() == 3
    thread.join()
    assert kept[0].count() == 5
    names = children(spark, app_folder(spark))
    assert not any(name.startswith("mine-") for name in names)


def test_nested_scopes_and_tables_that_outlive_one(spark):
    def staged(prefix):
        return sum(name.startswith(prefix) for name in children(spark, app_folder(spark)))

    with scratch(spark):
        with scratch(spark):
            stage(spark.range(1), "nested-inner")
            table = stage(spark.range(2), "nested-outer", outlives=True)
        assert (staged("nested-inner"), staged("nested-outer")) == (0, 1)
        assert table.count() == 2
    assert staged("nested-") == 0
    with scratch(spark):
        table = stage(spark.range(4), "nested-kept", outlives=True)
    assert table.count() == 4


def test_a_list_is_broadcast_up_to_its_limit(spark):
    rows, names = spark.range(1000), stage(spark.range(10), "list")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near, far = (rows.join(small(names, limit), "id", "left_anti") for limit in (1 << 20, 1))
        assert "BroadcastHashJoin" in plan_of(near) and "BroadcastHashJoin" not in plan_of(far)
        assert near.count() == far.count() == 990
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_reloads_leave_one_table(spark):
    def tables():
        return {name for name in children(spark, app_folder(spark)) if name.startswith("metadata-")}

    before, state = tables(), [0]
    table = Refreshing(lambda s: s.range(state[0] + 1), version=lambda _: state[0])
    for n in (0, 0, 1, 1, 1, 2):
        state[0] = n
        with scratch(spark):
            assert table.current(spark).count() == n + 1
    assert table.loads == 3
    assert len(tables() - before) == 1
