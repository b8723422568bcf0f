"""The endless copy: resume, read, decode, re-key, rename, write, save the position.

Each micro-batch is written under its batch id and its progress after it, both by replacement.
Spark logs the offsets of a batch before it runs, so a batch that was cut off is redone with the
same rows, replaces what it had written, and the target holds every row exactly once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ferrylog.functions.text import decode_payload
from ferrylog.operators import log as log_ops
from ferrylog.operators.ordered import number_rows
from ferrylog.plans.mirror import target_topic
from ferrylog.settings import LOG_KEYS
from ferrylog.sources import table
from ferrylog.staging import scratch, stage
from ferrylog.streaming.runs import run_available

_KEYS = list(LOG_KEYS)

PROGRESS_SCHEMA = "topic STRING, part INT, sent BIGINT, position BIGINT"


class OutOfOrder(ValueError):
    """The source went back in a partition, which a running count cannot follow."""


@dataclass(frozen=True)
class StreamMirror:
    """One mirror from a log stream to a Parquet target under ``root``.

    ``key="sequence"`` numbers rows 1 .. ``cycle`` along each partition; it needs a source that
    delivers a partition in offset order, batch after batch, as a topic does. ``starts`` is a table
    of start offsets (topic, part, start_off); rows below them are dropped, and a partition without a
    start, such as one that is new, is copied from its first row. A micro-batch is read two
    or three times; ``cache`` keeps it on the executors, for sources that are costly to read again.

    A batch may hold the rows of several triggers that were admitted together, each with its ``trigger``; it stands
    under the id of the first, and ``mirrored`` gives each row the id of its own.
    """

    root: str
    target: str
    value: str = "value"
    key: str = "keep"
    cycle: int = 100
    as_text: bool = False
    starts: DataFrame | None = None
    cache: bool = False

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    @property
    def progress(self) -> str:
        return f"{self.root}/progress"

    def run(self, stream: DataFrame) -> StreamingQuery:
        """Copy everything available now and stop."""
        return run_available(stream, self.copy, f"{self.root}/checkpoint")

    def start(self, stream: DataFrame, *, every: str = "60 seconds") -> StreamingQuery:
        """Copy for ever, saving the position once per trigger."""
        writer = stream.writeStream.foreachBatch(self.copy).option("checkpointLocation", f"{self.root}/checkpoint")
        return writer.trigger(processingTime=every).start()

    def copy(self, batch: DataFrame, batch_id: int) -> None:
        """Write one micro-batch, then the position it reached."""
        if self.cache:
            batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with scratch(batch.sparkSession):
                self._copy(batch, batch_id)
        finally:
            if self.cache:
                batch.unpersist()

    def _copy(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch if self.starts is None else log_ops.drop_old(batch, self.starts, position="start_off")
        went_back = Observation()
        progress = self._progress(rows, self._progress_of(batch.sparkSession, batch_id - 1))
        progress = stage(progress.observe(went_back, F.count_if("went_back").alias("partitions")), "progress")
        if self.key == "sequence":
            if went_back.get.get("partitions"):
                raise OutOfOrder("a partition came out of offset order; use key='keep' for such a source")
            rows = self._sequenced(rows, progress)
        if self.as_text:
            rows = rows.withColumn(self.value, decode_payload(F.col(self.value)))
        rows = log_ops.retopic(rows, target_topic(self.target))
        table.write_batch(table.laid_out(rows), self.data, batch_id)
        table.write_batch(progress.select(*LOG_KEYS, "sent", "position"), self.progress, batch_id)

    def _progress_of(self, spark: SparkSession, batch_id: int) -> DataFrame:
        last = table.last_batch(spark, self.progress, upto=batch_id)  # a batch of several triggers has the id of the first
        if last < 0:
            return spark.createDataFrame([], PROGRESS_SCHEMA)
        return spark.read.schema(PROGRESS_SCHEMA).parquet(table.batch_path(self.progress, last))

    @staticmethod
    def _progress(rows: DataFrame, before: DataFrame) -> DataFrame:
        """Rows sent and position reached in every partition, before and after the batch."""
        here = rows.groupBy(*LOG_KEYS).agg(
            F.min("off").alias("lowest"), (F.max("off") + 1).alias("end"), F.count("*").alias("n")
        )
        sent = F.coalesce(F.col("sent"), F.lit(0))
        return here.join(before, _KEYS, "full").select(
            *LOG_KEYS,
            sent.alias("sent_before"),
            (sent + F.coalesce(F.col("n"), F.lit(0))).alias("sent"),
            F.greatest("position", "end").alias("position"),
            (F.col("lowest") < F.col("position")).alias("went_back"),
        )

    def _sequenced(self, rows: DataFrame, progress: DataFrame) -> DataFrame:
        counted = number_rows(rows, "__rn").join(progress.select(*LOG_KEYS, "sent_before"), _KEYS)
        nth = F.col("__rn") + F.col("sent_before")
        return counted.withColumn("key", log_ops.sequence_key(nth, self.cycle)).drop("__rn", "sent_before")

    def mirrored(self, spark: SparkSession) -> DataFrame:
        """Everything copied so far."""
        rows = table.read_batches(spark, self.data)
        if "trigger" not in rows.columns:
            return rows
        return rows.withColumn("batch_id", F.coalesce("trigger", "batch_id")).drop("trigger")

    def positions(self, spark: SparkSession) -> DataFrame:
        """The saved position of every partition, usable as a checkpoint table."""
        saved = self._progress_of(spark, table.last_batch(spark, self.progress))
        return saved.select(*LOG_KEYS, F.col("position").alias("committed"))
