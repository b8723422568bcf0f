"""Late rows are booked, closed windows do not change, and a batch that is redone changes nothing."""

from conftest import rows_of
from pyspark.sql import functions as F

from ferrylog.streaming.volume import VolumeLedger


def batch(make, rows):
    made = make([("t", p, m, b"x" * size) for p, m, size in rows], "topic STRING, part INT, m INT, value BINARY")
    return made.withColumn("ts", F.expr("timestamp '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,m,0)"))


def windows(ledger, spark):
    rows = ledger.windows(spark, limit=25)
    return rows_of(rows.select("part", F.minute("win_start"), "bytes", "late_bytes", "late_rows", "over_limit", "closed"))


def test_in_time_and_late(make, spark, folder):
    ledger = VolumeLedger(folder, "10 minutes", "5 minutes")
    ledger.copy(batch(make, [(0, 1, 10), (0, 2, 10), (0, 12, 5), (1, 3, 1)]), 0)
    # the watermark is at 7: no window is closed yet
    ledger.copy(batch(make, [(0, 4, 10), (0, 27, 2)]), 1)
    assert windows(ledger, spark) == [
        (0, 0, 30, 0, 0, True, True), (0, 10, 5, 0, 0, False, True), (0, 20, 2, 0, 0, False, False), (1, 0, 1, 0, 0, False, True),
    ]
    # now it is at 22: the windows that end at 10 and 20 are closed, for all partitions alike
    third = batch(make, [(0, 9, 100), (0, 19, 7), (0, 19, 0), (0, 21, 3), (2, 5, 4)])
    for _ in range(2):  # done twice
        ledger.copy(third, 2)
        assert windows(ledger, spark) == [
            (0, 0, 30, 100, 1, True, True), (0, 10, 5, 7, 2, False, True), (0, 20, 5, 0, 0, False, False),
            (1, 0, 1, 0, 0, False, True), (2, 0, 0, 4, 1, False, True),
        ]
    # an empty batch keeps the watermark
    ledger.copy(third.where("part > 9"), 3)
    assert ledger.watermark(spark, 3) == ledger.watermark(spark, 2) == ledger.watermark(spark, 1)


def test_nothing_at_all(make, spark, folder):
    ledger = VolumeLedger(folder)
    ledger.copy(batch(make, []), 0)
    assert ledger.watermark(spark, 0) is None
    assert windows(ledger, spark) == []
