"""Segment directories of a stored log, and scans that open only those that can matter.

A log written with segment directories has a third partition column, ``seg``: the topic, the partition
and the offset divided by ``LAYOUT_SPAN``, as one text, since files are dropped column by column. What a job wants to read is first worked out as a list of (topic, part, seg), which is
staged. A semi join with it on partition columns lets Spark drop the other files before they are opened
(dynamic partition pruning). The list is joined only if it is small enough to be broadcast; beyond that
the scan stays as it is. The exact test on offsets follows in either case, so results are the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.settings import LOG_KEYS
from ferrylog.staging import LIST_BYTES, small, stage, staged_bytes

LAYOUT_SPAN = 1 << 17  # offsets, about one row group of kilobyte messages
SEGMENT = "seg"

_DIRS = [*LOG_KEYS, SEGMENT]


@dataclass(frozen=True)
class StoredLog:
    """Rows of a log with directories, and its manifest: ``(topic, part, seg, n, first_off, last_off, min_ts, max_ts, bytes)``.

    ``min_ts``, ``max_ts`` and ``bytes`` are NULL where the log was stored without a time or a size.
    """

    rows: DataFrame
    segments: DataFrame


def rows_of(log: DataFrame | StoredLog) -> DataFrame:
    return log.rows if isinstance(log, StoredLog) else log


def segment_name(number: Column) -> Column:
    """The directory of a segment of a topic's partition."""
    return F.concat_ws(".", F.col("topic"), F.col("part").cast("string"), number.cast("string"))


def segment_number(name: Column) -> Column:
    return F.substring_index(name, ".", -1).cast("bigint")


def directories(log: DataFrame | StoredLog) -> DataFrame:
    """The (topic, part, seg) that a log has, from the manifest, or from all files without reading a data column."""
    return log.segments if isinstance(log, StoredLog) else log.select(*_DIRS).distinct()


def only_segments(log: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of a log in the wanted (topic, part, seg); all of them if the log has no such directories."""
    if SEGMENT not in log.columns:
        return log
    listed = stage(wanted.select(*_DIRS).distinct(), "wanted-segments")
    if staged_bytes(listed) > LIST_BYTES:
        return log
    # the comparison tells the optimizer that the list leaves something out
    return log.join(small(listed.where(F.col(SEGMENT) >= "")), _DIRS, "left_semi")


def from_positions(log: DataFrame | StoredLog, positions: DataFrame, position: str, *, keep_unknown: bool = False) -> DataFrame:
    """The rows in segments that reach a partition's position, or, with ``keep_unknown``, of partitions without one."""
    rows = rows_of(log)
    if SEGMENT not in rows.columns:
        return rows
    known = directories(log).join(positions.select(*LOG_KEYS, position), list(LOG_KEYS), "left" if keep_unknown else "inner")
    end = F.col("last_off") + 1 if isinstance(log, StoredLog) else (segment_number(F.col(SEGMENT)) + 1) * LAYOUT_SPAN
    return only_segments(rows, known.where(~F.coalesce(F.col(position) >= end, F.lit(False))))


def at_offsets(log: DataFrame | StoredLog, offsets: DataFrame) -> DataFrame:
    """The rows in segments that hold one of the offsets ``(topic, part, off)``."""
    rows = rows_of(log)
    if SEGMENT not in rows.columns:
        return rows
    return only_segments(rows, offsets.select(*LOG_KEYS, segment_name(F.expr(f"off div {LAYOUT_SPAN}")).alias(SEGMENT)))
