"""Scans and row-wise work on a log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.functions.text import decode_payload, hash_partition, java_hash
from ferrylog.operators.ordered import SEGMENT_SPAN, number_rows
from ferrylog.operators.segments import StoredLog, from_positions
from ferrylog.settings import LOG_KEYS
from ferrylog.staging import stage


def scan_from(log: DataFrame | StoredLog, starts: DataFrame, *, position: str = "start_off") -> DataFrame:
    """Rows at or above each partition's start offset; partitions without a start are left out.

    ``starts`` has one row per partition and should be staged, so that its size is known.
    """
    near = from_positions(log, starts, position)
    return near.join(starts.select(*LOG_KEYS, position), list(LOG_KEYS)).where(F.col("off") >= F.col(position)).drop(position)


def drop_old(log: DataFrame | StoredLog, positions: DataFrame, *, position: str = "committed") -> DataFrame:
    """Rows at or above the requested offset; a partition without a request is read whole."""
    near = from_positions(log, positions, position, keep_unknown=True)
    joined = near.join(positions.select(*LOG_KEYS, position), list(LOG_KEYS), "left")
    return joined.where(F.col("off") >= F.coalesce(F.col(position), F.lit(0))).drop(position)


def bounded_read(log: DataFrame, limit: int, *, span: int = SEGMENT_SPAN) -> DataFrame:
    """The first ``limit`` rows of every partition, exactly."""
    head = number_rows(log, "rn", span=span, reach=lambda before: before["rn"] < limit)
    return head.where(F.col("rn") <= limit).drop("rn")


def decode(log: DataFrame, *, value: str = "value", text: str = "text") -> DataFrame:
    """Add the payload as text."""
    return log.withColumn(text, decode_payload(F.col(value)))


def retopic(
    log: DataFrame, target: str | Column | DataFrame, *, source_name: str | None = None
) -> DataFrame:
    """Write rows under their target topic.

    ``target`` is a name, an expression over the row, or a table ``(topic, target)``; topics
    missing from the table keep their name. ``source_name`` keeps the old topic in a column.
    """
    if isinstance(target, DataFrame):
        named = log.join(stage(target.select("topic", F.col("target").alias("__target")), "topics"), "topic", "left")
        renamed = F.coalesce(F.col("__target"), F.col("topic"))
    else:
        named = log
        renamed = F.lit(target) if isinstance(target, str) else target
    if source_name:
        named = named.withColumn(source_name, F.col("topic"))
    return named.withColumn("topic", renamed).drop("__target")


def sequence_key(nth: Column, cycle: int) -> Column:
    """Key text 1 .. ``cycle``, starting over after every full batch."""
    return ((nth - 1) % cycle + 1).cast("string")


def rekey_sequence(log: DataFrame, *, cycle: int = 100, name: str = "new_key", span: int = SEGMENT_SPAN) -> DataFrame:
    """Replace the key by a count along the partition that wraps after ``cycle`` rows."""
    return number_rows(log, "__rn", span=span).withColumn(name, sequence_key(F.col("__rn"), cycle)).drop("__rn")


def with_target_partition(
    log: DataFrame,
    partitions: int,
    *,
    key: str = "key",
    partition_by: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add ``jhash`` and ``target_part``; ``partition_by`` replaces the hash rule."""
    text = F.col(key).cast("string")
    chosen = partition_by(text) if partition_by else hash_partition(text, partitions)
    return log.withColumns({"jhash": java_hash(text), "target_part": chosen})


