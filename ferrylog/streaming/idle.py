"""Partitions that get no data."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ferrylog.settings import LOG_KEYS


def activity_sessions(log: DataFrame, *, gap: str, late: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Spans of activity per partition; a partition that is silent for ``gap`` ends its span.

    Works on a batch and on a stream. In append mode a span comes out when the watermark has passed
    its end, that is, when the partition has been idle for the whole gap.
    """
    timed = log.withColumn("__ts", F.col(ts).cast("timestamp"))
    if log.isStreaming:
        timed = timed.withWatermark("__ts", late)
    spans = timed.groupBy(*LOG_KEYS, F.session_window("__ts", gap)).agg(F.count("*").alias("n"))
    return spans.select(
        *LOG_KEYS,
        F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"),
        "n",
    )


def latest_per_batch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Newest time per partition in each Arrow batch, so that a hot partition ships few rows."""
    for frame in frames:
        yield frame.groupby(list(LOG_KEYS), as_index=False, sort=False)["ts"].max()


class IdleAlarm(StatefulProcessor):
    """Keeps the time of a partition's last row, and a timer that is pushed back by every new row."""

    def __init__(self, limit_ms: int, event_time: bool):
        self.limit_ms = limit_ms
        self.event_time = event_time

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ms BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest = max(frame["ts"].max() for frame in rows)
        seen = int(newest.timestamp() * 1000) if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        if self.last.exists():
            seen = max(seen, self.last.get()[0])
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        self.last.update((seen,))
        self.handle.registerTimer(seen + self.limit_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        since = self.last.get()[0]
        yield pd.DataFrame(
            {
                "topic": [key[0]],
                "part": [key[1]],
                "idle_since": [pd.Timestamp(since, unit="ms", tz="UTC")],
                "idle_ms": [expiredTimerInfo.getExpiryTimeInMs() - since],
            }
        )

    def close(self) -> None:
        pass


def idle_alarms(
    stream: DataFrame, *, limit_seconds: int = 1200, event_time: bool = False, late: str = "10 minutes", ts: str = "ts"
) -> DataFrame:
    """One row each time a partition has been silent for ``limit_seconds``.

    By processing time the alarm is raised while nothing arrives; by event time it is raised when
    the watermark passes. Needs the RocksDB state store.
    """
    timed = stream.select(*LOG_KEYS, F.col(ts).cast("timestamp").alias("ts"))
    small = timed.mapInPandas(latest_per_batch, "topic STRING, part INT, ts TIMESTAMP")
    if event_time:
        small = small.withWatermark("ts", late)
    return small.groupBy(*LOG_KEYS).transformWithStateInPandas(
        statefulProcessor=IdleAlarm(limit_seconds * 1000, event_time),
        outputStructType="topic STRING, part INT, idle_since TIMESTAMP, idle_ms BIGINT",
        outputMode="append" if event_time else "update",
        timeMode="EventTime" if event_time else "ProcessingTime",
    )
