"""Replaying failed offsets, and what a reader reports after each row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.operators.segments import StoredLog, at_offsets, from_positions, rows_of
from ferrylog.settings import LOG_KEYS
from ferrylog.staging import stage

_KEYS = list(LOG_KEYS)
_ROW = [*LOG_KEYS, "off"]

MORE_LEFT = "EMITTED_MORE_LEFT"
END = "EMITTED_END"
NOTHING = "NO_EMITTED"


def _ranges(failed: DataFrame) -> DataFrame:
    return failed.groupBy(*LOG_KEYS).agg(F.min("off").alias("__low"), F.max("off").alias("__high"))


def _matching(candidates: DataFrame, failed: DataFrame) -> DataFrame:
    """Candidates that are in the list.

    Not a semi join: Catalyst would push that below the range check, and shuffle the whole log.
    """
    return candidates.join(failed.select(*_ROW).distinct(), _ROW)


def rows_at(log: DataFrame | StoredLog, failed: DataFrame) -> DataFrame:
    """The rows of a log at the given offsets.

    Only rows between the lowest and the highest offset asked for in their partition are shuffled
    to meet the list, on a key that includes the offset and so has no hot value. The list should be
    staged, so that its size is known.
    """
    near = at_offsets(log, failed).join(stage(_ranges(failed), "ranges"), _KEYS)
    near = near.where(F.col("off").between(F.col("__low"), F.col("__high"))).select(rows_of(log).columns)
    return _matching(near, failed)


def replay_failed(log: DataFrame | StoredLog, failed: DataFrame, starts: DataFrame) -> DataFrame:
    """Partitions with failed offsets yield those rows only; the others go on from their start.

    What is known about a partition decides which of its rows can matter before any is shuffled. The
    list of failures is staged, so that a short one is broadcast and the log stays where it is.
    """
    columns = rows_of(log).columns
    failed = stage(failed.select(*_ROW), "failed")
    facts = stage(starts.select(*LOG_KEYS, "start_off").join(_ranges(failed), _KEYS, "full"), "replay")
    # partitions without failures from their start, the others in the segments of their failures
    going = facts.where("__low IS NULL").select(*LOG_KEYS, "start_off")
    fresh_log, again_log = from_positions(log, going, "start_off"), at_offsets(log, failed)
    fresh = fresh_log.join(facts, _KEYS)
    fresh = fresh.where(F.col("__low").isNull() & (F.col("off") >= F.col("start_off")))
    again = _matching(again_log.join(facts, _KEYS).where(F.col("off").between(F.col("__low"), F.col("__high"))), failed)
    return (
        fresh.select(columns)
        .withColumn("replayed", F.lit(False))
        .unionByName(again.select(columns).withColumn("replayed", F.lit(True)))
    )


def still_failed(log: DataFrame, failed: DataFrame) -> DataFrame:
    """Failed offsets that the log does not hold, which a replay leaves in the list."""
    return failed.join(rows_at(log.select(*_ROW), failed), _ROW, "left_anti")


def emit_state(log: DataFrame | StoredLog, starts: DataFrame, bounds: DataFrame, partitions: DataFrame | None = None) -> DataFrame:
    """After each row from the start: more left, or the last one; one row for empty reads.

    The last offset of a partition is known from its bounds, so no row has to look at the next. Of the known
    ``partitions`` those without any row have an empty read too.
    """
    ends = bounds.select(*LOG_KEYS, (F.col("latest") - 1).alias("__last"))
    if partitions is not None:
        ends = ends.join(partitions.select(*LOG_KEYS).distinct(), _KEYS, "full")
    facts = stage(ends.join(starts.select(*LOG_KEYS, "start_off"), _KEYS, "left"), "emit")
    near = from_positions(log, facts.where("start_off IS NOT NULL"), "start_off")
    taken = (
        near.select(*_ROW)
        .join(facts, _KEYS)
        .where(F.col("off") >= F.col("start_off"))
        .select(*_ROW, F.when(F.col("off") == F.col("__last"), END).otherwise(MORE_LEFT).alias("state"))
    )
    empty = facts.where(F.coalesce(F.col("start_off") > F.col("__last"), F.lit(True))).select(
        *LOG_KEYS, F.lit(None).cast("bigint").alias("off"), F.lit(NOTHING).alias("state")
    )
    return taken.unionByName(empty)
