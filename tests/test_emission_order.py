"""Replayed rows come before new ones, under numbers that a redone batch gives again."""

from conftest import rows_of
from pyspark.sql import functions as F

from ferrylog.sources import table
from ferrylog.streaming.replay import ReplayFromLog, tagged

SCHEMA = "off BIGINT, value BINARY, topic STRING, part INT"
FAILED = "topic STRING, part INT, off BIGINT"


def emitted(replay, spark):
    return rows_of(replay.replayed(spark).select("topic", "part", F.col("emission").cast("int"), "off", "replayed"))


def test_numbers_go_on_over_batches_and_do_not_change_when_a_batch_is_redone(spark, make, make_log, folder):
    feed = f"{folder}/feed"
    replay = ReplayFromLog(folder, lambda session: table.read_log(session, feed, SCHEMA), numbered=True)
    parts = [
        ([("t", 0, 1), ("t", 0, 4), ("u", 0, 9)], []),
        ([("t", 0, 5), ("t", 0, 7)], [("t", 0, 4), ("t", 0, 7), ("t", 0, 1), ("t", 0, 8)]),
        ([("t", 1, 2)], []),
        ([("t", 0, 8)], [("u", 0, 9)]),
    ]
    batches = []
    for n, (rows, failed) in enumerate(parts):
        table.write_log(make_log(rows), feed, mode="append")
        batches.append(tagged(make_log(rows).select("off", "value", "topic", "part"), make(failed, FAILED)))
        replay.copy(batches[n], n)
        replay.copy(batches[n], n)
    expected = sorted(
        [
            ("t", 0, 1, 1, False), ("t", 0, 2, 4, False), ("u", 0, 1, 9, False),
            ("t", 0, 3, 1, True), ("t", 0, 4, 4, True), ("t", 0, 5, 7, True), ("t", 0, 6, 5, False), ("t", 0, 7, 7, False),
            ("t", 1, 1, 2, False),
            ("t", 0, 8, 8, True), ("t", 0, 9, 8, False), ("u", 0, 2, 9, True),
        ],
        key=lambda row: tuple(map(str, row)),
    )
    assert emitted(replay, spark) == expected
    replay.copy(batches[3], 3)
    assert emitted(replay, spark) == expected
    assert rows_of(replay.numbers.read(spark)) == [("t", 0, 9), ("t", 1, 1), ("u", 0, 2)]


def test_empty_batches_emit_nothing(spark, make, make_log, folder):
    feed = f"{folder}/feed"
    table.write_log(make_log([("t", 0, 1)]), feed)
    replay = ReplayFromLog(folder, lambda session: table.read_log(session, feed, SCHEMA), numbered=True)
    nothing = tagged(make_log([]).select("off", "value", "topic", "part"), make([], FAILED))
    replay.copy(nothing, 0)
    replay.copy(tagged(make_log([]).select("off", "value", "topic", "part"), make([("t", 0, 1)], FAILED)), 1)
    assert emitted(replay, spark) == [("t", 0, 1, 1, True)]
