"""Bytes per partition and time window as a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ferrylog.functions.text import size_of
from ferrylog.settings import LOG_KEYS, MIB
from ferrylog.sources import table


def volume_stream(
    stream: DataFrame,
    *,
    width: str = "60 seconds",
    limit: int = 10 * MIB,
    late: str = "10 minutes",
    size: Column | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Running byte count of each window; rows later than ``late`` are dropped in append and update mode."""
    size = size_of(F.col("value")) if size is None else size
    timed = stream.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    windows = timed.groupBy(*LOG_KEYS, F.window("__ts", width)).agg(F.sum(size).alias("bytes"))
    return windows.select(
        *LOG_KEYS, F.col("window.start").alias("win_start"), "bytes", (F.col("bytes") > limit).alias("over_limit")
    )


@dataclass(frozen=True)
class VolumeLedger:
    """Bytes per partition and window of micro-batches, where rows that come too late are data too.

    A window is closed once the watermark, the newest time of the batches before less ``late``, has passed its
    end. What is in time is added to its window, and what comes for a closed one is booked as late, so the
    bytes of a closed window never change and none are lost: in time plus late is the total. Each batch writes
    its sums, a row per partition, window and kind, under its id, and the watermark it leaves after them.
    Nothing is kept as state, and a batch that is redone meets the same watermark and changes nothing.
    """

    root: str
    width: str = "60 seconds"
    late: str = "10 minutes"
    size: Column | None = None
    ts: str = "ts"

    def copy(self, batch: DataFrame, batch_id: int) -> None:
        """Book one micro-batch."""
        spark = batch.sparkSession
        size = size_of(F.col("value")) if self.size is None else self.size
        mark = self.watermark(spark, batch_id - 1)
        window = F.window(F.col(self.ts).cast("timestamp"), self.width)
        newest = Observation()
        sums = (
            batch.groupBy(*LOG_KEYS, window.alias("window"))
            .agg(F.sum(size).alias("bytes"), F.count("*").alias("n"), F.max(F.col(self.ts).cast("timestamp")).alias("newest"))
            .observe(newest, F.max(F.unix_micros("newest")).alias("micros"))
        )
        closed = F.lit(False) if mark is None else F.unix_micros("window.end") <= mark
        booked = sums.select(*LOG_KEYS, F.col("window.start").alias("win_start"), F.col("window.end").alias("win_end"), "bytes", "n", closed.alias("late"))
        table.write_batch(booked, f"{self.root}/sums", batch_id)
        seen = newest.get.get("micros")
        reached = spark.range(1).select(
            F.greatest(
                F.lit(mark).cast("bigint"), F.unix_micros(F.timestamp_micros(F.lit(seen).cast("bigint")) - F.expr(f"INTERVAL {self.late}"))
            ).alias("micros")
        )
        table.write_batch(reached, f"{self.root}/watermarks", batch_id)

    def watermark(self, spark: SparkSession, batch_id: int) -> int | None:
        """The watermark that a batch left, in microseconds; None before there was any row."""
        if batch_id < 0:
            return None
        row = spark.read.schema("micros BIGINT").parquet(table.batch_path(f"{self.root}/watermarks", batch_id)).first()
        return row and row.micros

    def windows(self, spark: SparkSession, *, limit: int = 10 * MIB) -> DataFrame:
        """``(topic, part, win_start, bytes, late_bytes, late_rows, over_limit, closed)`` of all batches so far."""
        mark = self.watermark(spark, table.last_batch(spark, f"{self.root}/watermarks"))
        rows = table.read_batches(spark, f"{self.root}/sums")
        late = lambda c: F.coalesce(F.sum(F.when(F.col("late"), F.col(c))), F.lit(0))
        return rows.groupBy(*LOG_KEYS, "win_start", "win_end").agg(
            F.coalesce(F.sum(F.when(~F.col("late"), F.col("bytes"))), F.lit(0)).alias("bytes"),
            late("bytes").alias("late_bytes"),
            late("n").alias("late_rows"),
        ).select(
            *LOG_KEYS, "win_start", "bytes", "late_bytes", "late_rows", (F.col("bytes") > limit).alias("over_limit"),
            F.coalesce(F.unix_micros("win_end") <= F.lit(mark), F.lit(False)).alias("closed"),
        )
