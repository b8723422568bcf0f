"""Offset bounds, start positions, repair and lag.

Everything here has one row per partition and is cheap; the only pass over a log is the partial
aggregation of ``offset_bounds`` and its relatives, and of a log with a manifest not even that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.operators.segments import StoredLog, only_segments, rows_of
from ferrylog.settings import LOG_KEYS
from ferrylog.staging import stage

_KEYS = list(LOG_KEYS)


def offset_bounds(log: DataFrame | StoredLog) -> DataFrame:
    """Earliest offset, next offset to be written, rows present and offsets missing."""
    if isinstance(log, StoredLog):
        bounds = log.segments.groupBy(*LOG_KEYS).agg(
            F.min("first_off").alias("earliest"), (F.max("last_off") + 1).alias("latest"), F.sum("n").alias("n_rows")
        )
    else:
        bounds = log.groupBy(*LOG_KEYS).agg(
            F.min("off").alias("earliest"), (F.max("off") + 1).alias("latest"), F.count("*").alias("n_rows")
        )
    return bounds.withColumn("n_missing", F.col("latest") - F.col("earliest") - F.col("n_rows"))


def offset_at_time(log: DataFrame | StoredLog, at: Column, *, ts: str = "ts") -> DataFrame:
    """First offset written at or after a time; the end of the log when there is none.

    Times need not rise along the offsets. With a manifest only the first segment that reaches the time is
    opened, and that only if it begins before it; a manifest that lacks times of some rows is not used.
    """
    if not isinstance(log, StoredLog) or not log.segments.where("max_ts IS NULL").isEmpty():
        return rows_of(log).groupBy(*LOG_KEYS).agg(
            F.coalesce(F.min(F.when(F.col(ts) >= at, F.col("off"))), F.max("off") + 1).alias("off")
        )
    reached = F.when(F.col("max_ts") >= at, F.struct("first_off", "min_ts", "seg"))
    found = log.segments.groupBy(*LOG_KEYS).agg((F.max("last_off") + 1).alias("end"), F.min(reached).alias("first"))
    found = stage(found.select(*LOG_KEYS, "end", "first.*", (F.col("first.min_ts") < at).alias("opened")), "at-time")
    rows = only_segments(log.rows, found.where("opened").select(*LOG_KEYS, "seg"))
    inside = rows.where(F.col(ts) >= at).groupBy(*LOG_KEYS).agg(F.min("off").alias("inside"))
    both = found.join(inside, _KEYS, "left")
    return both.select(
        *LOG_KEYS, F.coalesce(F.when(F.col("opened"), F.col("inside")).otherwise(F.col("first_off")), F.col("end")).alias("off")
    )


def default_offset(bounds: DataFrame, force: Column | bool, *, start: Column | str = "earliest") -> DataFrame:
    """Latest, unless a start is forced."""
    force = F.lit(force) if isinstance(force, bool) else force
    start = F.col(start) if isinstance(start, str) else start
    return bounds.withColumn("off", F.when(force, start).otherwise(F.col("latest")))


def next_offset(log: DataFrame | StoredLog, positions: DataFrame, *, position: str = "committed") -> DataFrame:
    """Next read position: past the last row, and never before the old position."""
    ends = offset_bounds(log).select(*LOG_KEYS, F.col("latest").alias("__end"))
    old = positions.select(*LOG_KEYS, position)
    return ends.join(old, _KEYS, "left").select(
        *LOG_KEYS, F.greatest(F.coalesce(F.col(position), F.lit(0)), F.col("__end")).alias("next_off")
    )


def resolve_start(bounds: DataFrame, checkpoints: DataFrame, *, start: str = "earliest") -> DataFrame:
    """Saved offset, or the column ``start`` when there is none, or it is negative or trimmed away.

    A saved offset past the end is kept; ``out_of_range`` repairs it.
    """
    saved, earliest = F.col("committed"), F.col("earliest")
    unusable = saved.isNull() | (saved < earliest) | (saved < 0)
    return (
        bounds.select(*LOG_KEYS, "earliest", F.col(start).alias("__start"))
        .join(checkpoints.select(*LOG_KEYS, "committed"), _KEYS, "left")
        .withColumn("start_off", F.when(unusable, F.col("__start")).otherwise(saved))
        .drop("__start")
    )


def resolve_start_job(
    bounds: DataFrame,
    checkpoints: DataFrame,
    *,
    job_id: str,
    force: bool = False,
    start: Column | str = "earliest",
    max_behind: int = 2**63 - 1,
) -> DataFrame:
    """Start rule that also looks at which job saved the offset, with the reason for the choice."""
    start = F.col(start) if isinstance(start, str) else start
    saved = F.col("committed")
    missing = saved.isNull() | F.col("job_id").isNull()
    other_job = F.lit(force) & (F.col("job_id") != job_id)
    reason = (
        F.when(missing, "no_record")
        .when(other_job, "forced")
        .when(start - saved > max_behind, "too_far")
        .when(saved <= 0, "non_positive")
        .otherwise("saved")
    )
    return (
        bounds.join(checkpoints.select(*LOG_KEYS, "job_id", "committed"), _KEYS, "left")
        .withColumn("reason", reason)
        .withColumn("start_off", F.when(F.col("reason") == "saved", saved).otherwise(start))
    )


POLICIES = ("earliest", "latest", "fail")


def out_of_range(
    bounds: DataFrame, checkpoints: DataFrame, *, policy: str = "earliest", position: str = "committed"
) -> DataFrame:
    """Where a position lies relative to the log, and the position to go on from.

    An offset equal to the end is in range. ``policy`` says where a position outside is set to, or
    that the job is to fail on it. A partition without a record starts where the policy says,
    or at the earliest offset.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {', '.join(POLICIES)}, not {policy!r}")
    saved = F.col(position)
    status = (
        F.when(saved.isNull(), "no_record")
        .when(saved < F.col("earliest"), "below")
        .when(saved > F.col("latest"), "above")
        .otherwise("in_range")
    )
    if policy == "fail":
        where = F.format_string("offset %d of %s, partition %d, is out of range", position, *LOG_KEYS)
        reset = F.when(F.col("status") == "no_record", F.col("earliest")).otherwise(F.raise_error(where).cast("bigint"))
    else:
        reset = F.col(policy)
    return (
        bounds.join(checkpoints.select(*LOG_KEYS, position), _KEYS, "left")
        .withColumn("status", status)
        .withColumn("reset_off", F.when(F.col("status") == "in_range", saved).otherwise(reset))
        .withColumn("policy", F.lit(policy))
    )


def offset_lag(bounds: DataFrame, checkpoints: DataFrame, *, max_behind: int = 2**63 - 1) -> DataFrame:
    """How far each saved offset is behind the end of its partition."""
    return (
        bounds.join(checkpoints.select(*LOG_KEYS, "committed"), _KEYS)
        .withColumn("lag", F.col("latest") - F.col("committed"))
        .withColumn("too_far", F.col("lag") > max_behind)
    )


def inflight_after(emitted: DataFrame, finished: DataFrame, *, position: str = "committed") -> DataFrame:
    """``inflight_offsets`` where all offsets below a position are finished, without a shuffle of rows.

    ``finished`` has one row per partition and should be staged; partitions without one are unfinished.
    """
    joined = emitted.select(*LOG_KEYS, "off").join(finished.select(*LOG_KEYS, position), _KEYS, "left")
    still = F.coalesce(F.col("off") >= F.col(position), F.lit(True))
    return joined.groupBy(*LOG_KEYS).agg(
        F.count_if(still).alias("n_inflight"), F.coalesce(F.min(F.when(still, F.col("off"))), F.max("off") + 1).alias("safe_off")
    )


def inflight_offsets(emitted: DataFrame, finished: DataFrame) -> DataFrame:
    """Unfinished rows per partition, and the position that is safe to save.

    Emitted and finished offsets are matched by one aggregation on (topic, part, off), which takes
    duplicates on either side and has no hot key; finished offsets that were never emitted do not
    count.
    """
    both = emitted.select(*LOG_KEYS, "off", F.lit(True).alias("__emitted")).unionByName(
        finished.select(*LOG_KEYS, "off", F.lit(False).alias("__emitted"))
    )
    offsets = (
        both.groupBy(*LOG_KEYS, "off")
        .agg(F.bool_or("__emitted").alias("__emitted"), F.bool_and("__emitted").alias("__open"))
        .where("__emitted")
    )
    return offsets.groupBy(*LOG_KEYS).agg(
        F.count_if("__open").alias("n_inflight"),
        F.coalesce(F.min(F.when(F.col("__open"), F.col("off"))), F.max("off") + 1).alias("safe_off"),
    )
