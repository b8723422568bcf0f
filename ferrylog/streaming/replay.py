"""Failed offsets, replayed before new rows.

``ReplayFromLog`` reads failed rows again from the log, as a reader does that goes back to the
lowest failed offset. Its state is the list of failures still open, and all of it stays on the JVM
side. ``replay_stream`` is for sources that cannot be read again: it joins the rows with the failures
and keeps them as state for as long as they may be replayed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylog.operators.ordered import number_rows
from ferrylog.operators.replay import rows_at
from ferrylog.settings import LOG_KEYS
from ferrylog.sources import table
from ferrylog.sources.deltas import DeltaTable
from ferrylog.staging import scratch, stage

def replay_stream(
    log: DataFrame,
    failed: DataFrame,
    *,
    value: str = "value",
    ts: str | None = None,
    failed_at: str = "failed_at",
    keep: str = "1 day",
    late: str = "10 minutes",
) -> DataFrame:
    """New rows as they come, and once more every row whose offset is reported as failed.

    Rows and failures meet in a stream-stream join on (topic, part, off), so no key is hot and all of it
    stays on the JVM side; a failure may come before its row. An offset reported again is replayed once.
    With ``ts``, the column of a row's time, a failure counts if its own time ``failed_at`` is within
    ``keep`` after it. Both sides then have a watermark that allows for ``late`` rows, and rows and
    failures leave the state when it has passed. Without ``ts`` they are kept for ever.
    """
    rows = log.select(*LOG_KEYS, "off", F.col(value).alias("value"), *([F.col(ts).cast("timestamp").alias("__ts")] if ts else []))
    key = ["topic", "part", "off"]
    names = [F.col(c).alias(f"__{c}") for c in key]
    same = (F.col("topic") == F.col("__topic")) & (F.col("part") == F.col("__part")) & (F.col("off") == F.col("__off"))
    if ts:
        kept = rows.withWatermark("__ts", late)
        notices = failed.select(*names, F.col(failed_at).cast("timestamp").alias("__at")).withWatermark("__at", late)
        notices = notices.dropDuplicatesWithinWatermark(["__topic", "__part", "__off"])
        same &= F.expr(f"__at >= __ts AND __at <= __ts + INTERVAL {keep}")
    else:
        kept, notices = rows, failed.select(*names).dropDuplicates()
    again = kept.join(notices, same).select(*key, "value", F.lit(True).alias("replayed"))
    return rows.select(*key, "value", F.lit(False).alias("replayed")).unionByName(again)


@dataclass(frozen=True)
class ReplayFromLog:
    """New rows as they come; failed ones are read again from the log the stream comes from.

    ``read_log`` gives that log as a batch table. Each micro-batch is written under its id, with the
    failures it leaves open, so that redoing it changes nothing. A failure beyond the end of the log
    stays open until its row is there.

    With ``numbered`` every row has its place in the order of emission of its partition, ``emission`` 1, 2, 3, ...:
    batch by batch, in a batch first the replayed rows and then the new ones, each in offset order. The numbers
    reached are carried from batch to batch as deltas of the partitions that moved.
    """

    root: str
    read_log: Callable[[SparkSession], DataFrame]
    numbered: bool = False

    def copy(self, batch: DataFrame, batch_id: int) -> None:
        """Take rows with ``failed = false`` as new, and offsets with ``failed = true`` as notices."""
        with scratch(batch.sparkSession):
            self._copy(batch, batch_id)

    def _copy(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        notices = batch.where("failed").select(*LOG_KEYS, "off")
        wanted = stage(self._open_before(spark, batch_id).unionByName(notices).distinct(), "wanted")
        log = self.read_log(spark)
        fresh = batch.where(~F.col("failed")).select(log.columns)
        if wanted.isEmpty():  # the log is not read again
            self._emit(fresh, None, batch_id)
            table.write_batch(wanted, f"{self.root}/open", batch_id)
            return
        again = stage(rows_at(log, wanted).select(log.columns), "again")
        self._emit(fresh, again, batch_id)
        left = wanted.join(again.select(*LOG_KEYS, "off"), [*LOG_KEYS, "off"], "left_anti")
        table.write_batch(left, f"{self.root}/open", batch_id)

    def _emit(self, fresh: DataFrame, again: DataFrame | None, batch_id: int) -> None:
        """Write the rows of a batch; ``again`` is staged."""
        if self.numbered:
            fresh, again = self._in_order(fresh, again, batch_id)
        out = fresh.withColumn("replayed", F.lit(False))
        if again is not None:
            out = again.withColumn("replayed", F.lit(True)).unionByName(out)
        table.write_batch(out, f"{self.root}/out", batch_id)
        if self.numbered:  # read back: what was written is what later numbers go on from
            written = fresh.sparkSession.read.schema(out.schema).parquet(table.batch_path(f"{self.root}/out", batch_id))
            self.numbers.write(written.groupBy(*LOG_KEYS).agg(F.max("emission").alias("reached")), batch_id)

    def _in_order(self, fresh: DataFrame, again: DataFrame | None, batch_id: int) -> tuple[DataFrame, DataFrame | None]:
        """Both kinds of rows with ``emission``; running totals, so that no partition is sorted in one task."""
        keys = list(LOG_KEYS)
        before = self.numbers.read(fresh.sparkSession, batch_id - 1)
        if again is not None:
            counts = again.groupBy(*keys).agg(F.count("*").alias("__again"))
            before = before.join(counts, keys, "full")
        else:
            before = before.withColumn("__again", F.lit(0).cast("bigint"))
        first, ahead = F.coalesce("reached", F.lit(0)), F.coalesce("__again", F.lit(0))
        facts = stage(before.select(*keys, first.alias("__first"), ahead.alias("__ahead")), "emission")

        def numbered(rows: DataFrame, base: Column) -> DataFrame:
            placed = number_rows(rows, "emission").join(facts, keys, "left")
            return placed.withColumn("emission", F.col("emission") + F.coalesce(base, F.lit(0))).drop("__first", "__ahead")

        later = numbered(fresh, F.col("__first") + F.col("__ahead"))
        return later, None if again is None else numbered(again, F.col("__first"))

    @property
    def numbers(self) -> DeltaTable:
        """The emission number that each partition has reached."""
        return DeltaTable(f"{self.root}/numbers", "topic STRING, part INT, reached BIGINT", LOG_KEYS, 32)

    def _open_before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        schema = "topic STRING, part INT, off BIGINT"
        if batch_id == 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(table.batch_path(f"{self.root}/open", batch_id - 1))

    def replayed(self, spark: SparkSession) -> DataFrame:
        """Everything emitted so far."""
        return table.read_batches(spark, f"{self.root}/out")


def tagged(log: DataFrame, failed: DataFrame) -> DataFrame:
    """New rows and failure notices as one stream for ``ReplayFromLog``."""
    notices = failed.select(*LOG_KEYS, "off").withColumn("failed", F.lit(True))
    return log.withColumn("failed", F.lit(False)).unionByName(notices, allowMissingColumns=True)
