"""Admission by offset, partition and time: which offsets of a stored log a trigger may take.

Every partition has a token bucket of payload bytes. It fills up with time, and a trigger takes the longest run
of rows, from the position on, whose bytes are within its level. Rows are admitted in offset order, however
the files of the log lie, and a partition that has much to send does not hold up the others.

Runs of bytes are differences of running totals. The totals at the ends of segments come from the manifest,
so a plan opens one segment in each partition at most, the one in which its level runs out, whatever it
admits and however long the log is.

A plan is written under the id of its batch before its rows are read, with positions and levels. A batch that
was cut off is redone with the same plan, and a sink that replaces a batch by its id has every row once.

Where the times of triggers are known, as in runs over a log that is all there, the plans of many are made in one
round: each partition is walked through the rows next to come, at most ``AHEAD_ROWS`` of them, in a task of its own. A round
ends before the first trigger that some partition's rows do not decide, and a trigger that takes more is planned alone.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrylog.functions.text import size_of
from ferrylog.operators.ordered import accumulate
from ferrylog.operators.segments import SEGMENT, StoredLog, only_segments, segment_number
from ferrylog.settings import LOG_KEYS, MIB
from ferrylog.sources import table
from ferrylog.staging import exists, scratch, small, stage

_KEYS = list(LOG_KEYS)

PLAN_SCHEMA = (
    "topic STRING, part INT, from_off BIGINT, position BIGINT, n BIGINT, bytes BIGINT, "
    "level BIGINT, at BIGINT, sent_rows BIGINT, sent_bytes BIGINT"
)
#: Plans as they are written: under the id of the first trigger of their round, each with its own in ``trigger``.
_ROUND_SCHEMA = PLAN_SCHEMA + ", trigger BIGINT"

#: Triggers planned in a round at most, and rows of a partition that a round looks at.
AHEAD = 1024
AHEAD_ROWS = 1 << 20
_STRETCH = 1 << 10


@dataclass(frozen=True)
class Bucket:
    """``capacity`` bytes at most, refilled at ``capacity`` in ``seconds``; a bucket is full at first."""

    capacity: int = 10 * MIB
    seconds: float = 60.0

    @property
    def rate(self) -> float:
        """Bytes in a microsecond."""
        return self.capacity / (self.seconds * 1e6)

    def level(self, level: Column, since_micros: Column) -> Column:
        """The level after so many microseconds; a debt is paid off before anything is admitted."""
        gained = F.floor(since_micros * self.rate).cast("bigint")
        return F.least(F.lit(self.capacity).cast("bigint"), level + gained)


def _walk(state: pd.Series, rows: pd.DataFrame, bucket: Bucket, first: int, times: list[int]) -> list[tuple]:
    """The plans of a partition for triggers at ``times``, as far as ``rows``, the next ones by offset, decide them."""
    off, size, count, total = (rows[name].to_numpy() for name in ("off", "size", "rows", "total"))
    position, level = int(state["position"]), int(state["level"])
    sent_rows, sent_bytes = int(state["sent_rows"]), int(state["sent_bytes"])
    plans = []
    for k, now in enumerate(times):
        if k:
            level = min(bucket.capacity, level + int(np.floor((now - times[k - 1]) * bucket.rate)))
        upto = sent_bytes + level
        if not state["complete"] and (not len(total) or upto >= total[-1]):
            break
        from_off, rows_to, bytes_to = position, sent_rows, sent_bytes
        if level >= 0:
            end = int(np.searchsorted(total, upto, side="right"))
            # a row that is larger than a bucket goes alone, when the bucket is full, and leaves a debt
            alone = level == bucket.capacity and end < len(off) and size[end] > bucket.capacity
            end += bool(alone and total[end] - size[end] == sent_bytes)
            if end and off[end - 1] >= position:
                position, rows_to, bytes_to = int(off[end - 1]) + 1, int(count[end - 1]), int(total[end - 1])
        level -= bytes_to - sent_bytes
        plans.append((from_off, position, rows_to - sent_rows, bytes_to - sent_bytes, level, now, rows_to, bytes_to, first + k))
        sent_rows, sent_bytes = rows_to, bytes_to
    return plans


def totals(log: StoredLog) -> DataFrame:
    """The manifest with the rows and bytes before each segment, staged: ``(.., number, rows_before, bytes_before)``."""
    numbered = log.segments.withColumn("number", segment_number(F.col(SEGMENT)))
    summed = accumulate(numbered, sums={"rows_to": F.col("n"), "bytes_to": F.coalesce("bytes", F.lit(0))}, order="number")
    return stage(
        summed.select(
            *LOG_KEYS, SEGMENT, "n", "first_off", "last_off", F.coalesce("bytes", F.lit(0)).alias("bytes"),
            (F.col("rows_to") - F.col("n")).alias("rows_before"),
            (F.col("bytes_to") - F.coalesce("bytes", F.lit(0))).alias("bytes_before"),
        ),
        "totals",
    )


def before_offsets(log: StoredLog, segments: DataFrame, positions: DataFrame, size: Column) -> DataFrame:
    """``positions(topic, part, start_off)`` with the rows and bytes of the partition that lie before each."""
    here = segments.join(positions.select(*LOG_KEYS, "start_off"), _KEYS)
    whole = here.where("last_off < start_off").groupBy(*LOG_KEYS).agg(F.sum("n").alias("rows"), F.sum("bytes").alias("bytes"))
    cut = stage(here.where("first_off < start_off AND last_off >= start_off").select(*LOG_KEYS, SEGMENT, "start_off"), "cut")
    inside = only_segments(log.rows, cut).join(cut.select(*LOG_KEYS, "start_off"), _KEYS).where("off < start_off")
    inside = inside.groupBy(*LOG_KEYS).agg(F.count("*").alias("rows"), F.sum(size).alias("bytes"))
    both = whole.unionByName(inside).groupBy(*LOG_KEYS).agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    return positions.join(both, _KEYS, "left").fillna(0, ["rows", "bytes"])


@dataclass
class Admission:
    """Reads ``log`` under a bucket for each partition, beginning at ``starts(topic, part, start_off)`` or at the first row.

    ``log`` is asked for its manifest once; a log that grows is given anew with the same ``root``, and goes on
    where the last plan ended. Partitions that are missing from ``starts``, such as new ones, are read whole.
    """

    log: StoredLog
    root: str
    bucket: Bucket = Bucket()
    size: Column | None = None
    starts: DataFrame | None = None

    def __post_init__(self) -> None:
        self._size = F.coalesce(size_of(F.col("value")) if self.size is None else self.size, F.lit(0)).cast("bigint")
        self._segments = totals(self.log)
        self._begin = None
        if self.starts is not None:
            self._begin = stage(before_offsets(self.log, self._segments, self.starts.select(*LOG_KEYS, "start_off"), self._size), "begin")

    @property
    def plans(self) -> str:
        return f"{self.root}/plans"

    def plan_of(self, spark: SparkSession, batch_id: int) -> DataFrame:
        first = table.last_batch(spark, self.plans, upto=batch_id)
        if batch_id < 0 or first < 0:
            return spark.createDataFrame([], PLAN_SCHEMA)
        plans = spark.read.schema(_ROUND_SCHEMA).parquet(table.batch_path(self.plans, first))
        return plans.where(F.coalesce("trigger", F.lit(first)) == batch_id).drop("trigger")

    def _states(self, before: DataFrame, now: int) -> DataFrame:
        """Position, totals sent and level of every partition of the log when a trigger begins."""
        ends = self._segments.groupBy(*LOG_KEYS).agg(F.min("first_off").alias("earliest"))
        known = ends.join(before.select(*LOG_KEYS, "position", "level", "at", "sent_rows", "sent_bytes"), _KEYS, "left")
        if self._begin is not None:
            known = known.join(self._begin, _KEYS, "left")
        else:
            known = known.withColumns({c: F.lit(None).cast("bigint") for c in ("start_off", "rows", "bytes")})
        full = F.lit(self.bucket.capacity).cast("bigint")
        return known.select(
            *LOG_KEYS,
            F.coalesce("position", "start_off", "earliest").alias("position"),
            F.coalesce("sent_rows", "rows", F.lit(0)).alias("sent_rows"),
            F.coalesce("sent_bytes", "bytes", F.lit(0)).alias("sent_bytes"),
            F.coalesce(self.bucket.level(F.col("level"), F.lit(now) - F.col("at")), full).alias("level"),
        )

    def plan(self, spark: SparkSession, batch_id: int, now: int) -> DataFrame:
        """The plan of a batch at ``now`` (microseconds): made and written, or the one that was written before."""
        if exists(spark, f"{table.batch_path(self.plans, batch_id)}/_SUCCESS"):
            return self.plan_of(spark, batch_id)
        with scratch(spark):
            states = self._states(self.plan_of(spark, batch_id - 1), now)
            upto = F.col("sent_bytes") + F.col("level")
            ahead = self._segments.join(states, _KEYS).where((F.col("last_off") >= F.col("position")) & (F.col("level") >= 0))
            reached = F.col("bytes_before") + F.col("bytes")
            whole = ahead.where(reached <= upto).groupBy(*LOG_KEYS).agg(
                (F.max("last_off") + 1).alias("whole_end"),
                F.max(F.col("rows_before") + F.col("n")).alias("whole_rows"),
                F.max(reached).alias("whole_bytes"),
            )
            # the segment in which the level runs out
            last = ahead.where((reached > upto) & (F.col("bytes_before") <= upto))
            last = stage(last.select(*LOG_KEYS, SEGMENT, "rows_before", "bytes_before", "position", "level", upto.alias("upto")), "last")
            in_order = Window.partitionBy(*LOG_KEYS).orderBy("off")
            so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            # a row for each partition, whose segment is the only one that is opened
            rows = self.log.rows.select(*LOG_KEYS, SEGMENT, "off", self._size.alias("size"))
            rows = rows.join(small(last.where(F.col(SEGMENT) >= "")), [*LOG_KEYS, SEGMENT]).select(
                *LOG_KEYS, "off", "position", "level", "upto", "size",
                (F.col("rows_before") + F.count("*").over(so_far)).alias("rows"),
                (F.col("bytes_before") + F.sum("size").over(so_far)).alias("total"),
            )
            rows = rows.where("off >= position")
            # a row that is larger than a bucket goes alone, when the bucket is full, and leaves a debt
            alone = (F.col("level") == self.bucket.capacity) & (F.col("total") - F.col("size") == F.col("upto") - F.col("level"))
            partly = rows.where((F.col("total") <= F.col("upto")) | alone & (F.col("size") > self.bucket.capacity))
            partly = partly.groupBy(*LOG_KEYS).agg(
                (F.max("off") + 1).alias("part_end"), F.max("rows").alias("part_rows"), F.max("total").alias("part_bytes")
            )
            both = states.join(whole, _KEYS, "left").join(partly, _KEYS, "left")
            position = F.greatest("position", "whole_end", "part_end")
            rows_to, bytes_to = F.greatest("sent_rows", "whole_rows", "part_rows"), F.greatest("sent_bytes", "whole_bytes", "part_bytes")
            plan = both.select(
                *LOG_KEYS,
                F.col("position").alias("from_off"),
                position.alias("position"),
                (rows_to - F.col("sent_rows")).alias("n"),
                (bytes_to - F.col("sent_bytes")).alias("bytes"),
                (F.col("level") - bytes_to + F.col("sent_bytes")).alias("level"),
                F.lit(now).cast("bigint").alias("at"),
                rows_to.alias("sent_rows"),
                bytes_to.alias("sent_bytes"),
            )
            table.write_batch(plan, self.plans, batch_id)
        return self.plan_of(spark, batch_id)

    def plan_ahead(self, spark: SparkSession, first: int, times: list[int]) -> DataFrame:
        """The plans of triggers from ``first`` on, one at least, with their ids in ``trigger``; written under ``first``.

        The last one is that with which the log is all admitted, or the last of ``times`` that can be planned together.
        """
        path = table.batch_path(self.plans, first)
        if not exists(spark, f"{path}/_SUCCESS"):
            with scratch(spark):
                walked = self._walked(spark, first, times)
                seen = walked.groupBy(*LOG_KEYS).agg(F.max("trigger").alias("last"), F.min(F.when(F.col("past"), F.col("trigger"))).alias("done"))
                known, done, open_ones = seen.agg(F.min(F.coalesce("last", F.lit(first - 1))), F.max("done"), F.count_if(F.col("done").isNull())).first()
                if known is None or known < first:
                    self.plan(spark, first, times[0])
                else:
                    last = known if open_ones else min(known, done)
                    table.write_batch(walked.where(F.col("trigger") <= last).drop("past"), self.plans, first)
        plans = spark.read.schema(_ROUND_SCHEMA).parquet(path)
        return plans.withColumn("trigger", F.coalesce("trigger", F.lit(first).cast("bigint")))

    def _walked(self, spark: SparkSession, first: int, times: list[int]) -> DataFrame:
        """Plans as far as the rows ahead decide them, and whether a partition is admitted with them; no trigger if none is."""
        bucket = self.bucket
        states = self._states(self.plan_of(spark, first - 1), times[0])
        ends = self._segments.groupBy(*LOG_KEYS).agg(F.max("last_off").alias("end"), F.sum("n").alias("all_rows"))
        states = stage(states.join(ends, _KEYS), "states")
        rows_end = F.col("sent_rows") + AHEAD_ROWS
        ahead = self._segments.join(states, _KEYS).where((F.col("last_off") >= F.col("position")) & (F.col("rows_before") < rows_end))
        ahead = stage(ahead.select(*LOG_KEYS, SEGMENT, "rows_before", "bytes_before", "position", rows_end.alias("rows_end")), "ahead")
        rows = self.log.rows.select(*LOG_KEYS, SEGMENT, "off", self._size.alias("size"))
        rows = rows.join(small(ahead.where(F.col(SEGMENT) >= "")), [*LOG_KEYS, SEGMENT])
        so_far = Window.partitionBy(*LOG_KEYS, SEGMENT).orderBy("off").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.select(
            *LOG_KEYS, "off", "size", "position", "rows_end",
            (F.col("rows_before") + F.count("*").over(so_far)).alias("rows"),
            (F.col("bytes_before") + F.sum("size").over(so_far)).alias("total"),
        )
        rows = rows.where("off >= position AND rows <= rows_end").drop("position", "rows_end")
        states = states.withColumn("complete", F.col("all_rows") <= rows_end)

        def walk(state: pd.DataFrame, ahead: pd.DataFrame) -> pd.DataFrame:
            if not len(state):
                return pd.DataFrame(columns=columns)
            one, ahead = state.iloc[0], ahead.sort_values("off")
            plans = _walk(one, ahead, bucket, first, times) or [(*[None] * 9,)]
            return pd.DataFrame([(one["topic"], one["part"], *p, p[1] is not None and p[1] > one["end"]) for p in plans], columns=columns, dtype=object)

        schema = _ROUND_SCHEMA + ", past BOOLEAN"
        columns = [field.split()[0] for field in schema.split(", ")]
        return stage(states.groupBy(*LOG_KEYS).cogroup(rows.groupBy(*LOG_KEYS)).applyInPandas(walk, schema), "walked")

    def rows(self, plan: DataFrame) -> DataFrame:
        """The rows that a plan admits; only their segments are opened."""
        wanted = plan.where("n > 0").select(*LOG_KEYS, "from_off", F.col("position").alias("upto"))
        lists = self._segments.join(wanted, _KEYS).where("last_off >= from_off AND first_off < upto")
        near = only_segments(self.log.rows, lists).join(wanted, _KEYS)
        return near.where("off >= from_off AND off < upto").select(*self.log.rows.columns)

    def rows_ahead(self, plans: DataFrame) -> DataFrame:
        """The rows that the plans of a round admit, each with its ``trigger``."""
        wanted = plans.where("n > 0").select(*LOG_KEYS, "trigger", "from_off", F.col("position").alias("upto"))
        spans = wanted.groupBy(*LOG_KEYS).agg(F.min("from_off").alias("from_off"), F.max("upto").alias("upto"))
        lists = self._segments.join(spans, _KEYS).where("last_off >= from_off AND first_off < upto")
        # a row meets the few triggers of its own stretch of offsets
        stretch = lambda c: F.expr(f"{c} div {_STRETCH}")
        near = only_segments(self.log.rows, lists).withColumn("__at", stretch("off"))
        cut = wanted.withColumn("__at", F.explode(F.sequence(stretch("from_off"), stretch("(upto - 1)"))))
        met = near.join(small(stage(cut, "triggers")), [*LOG_KEYS, "__at"]).where("off >= from_off AND off < upto")
        return met.select(*self.log.rows.columns, "trigger")

    def _left(self, plan: DataFrame) -> DataFrame:
        """Partitions that hold rows behind a plan; the log may have grown since it was made."""
        ends = self._segments.groupBy(*LOG_KEYS).agg(F.max("last_off").alias("end"))
        return ends.join(plan, _KEYS, "left").where(F.coalesce(F.col("position") <= F.col("end"), F.lit(True)))

    def run(
        self,
        spark: SparkSession,
        copy: Callable[[DataFrame, int], None] | None = None,
        *,
        every: float = 60.0,
        clock: Callable[[int], int] | None = None,
        wait: bool = False,
    ) -> int:
        """Trigger until all of the log is admitted; return the number of batches there are.

        ``copy`` gets the rows and the id of each batch. ``clock`` gives the time of a batch in microseconds;
        by default it is that of the machine, and with ``wait`` a trigger begins ``every`` seconds after
        the one before it.
        """
        batch_id = max(table.last_batch(spark, self.plans), 0)  # the last one may not have been copied
        while True:
            began = time.time()
            plan = self.plan(spark, batch_id, clock(batch_id) if clock else int(began * 1e6))
            if copy is not None:
                with scratch(spark):
                    copy(self.rows(plan), batch_id)
            batch_id += 1
            if self._left(plan).isEmpty():
                return batch_id
            if wait:
                time.sleep(max(0.0, began + every - time.time()))

    def run_ahead(
        self, spark: SparkSession, copy: Callable[[DataFrame, int], None] | None = None, *, clock: Callable[[int], int], ahead: int = AHEAD
    ) -> int:
        """As ``run`` with a clock, in rounds: the plans of up to ``ahead`` triggers are made together, and their rows copied together.

        ``copy`` gets the rows of a round, with their ``trigger``, and the id of the first of them. The last round is redone when
        a run goes on, with the same plans.
        """
        first = max(table.last_batch(spark, self.plans), 0)
        while True:
            with scratch(spark):
                plans = self.plan_ahead(spark, first, [clock(first + k) for k in range(ahead)])
                if copy is not None:
                    copy(self.rows_ahead(plans), first)
            last = plans.agg(F.max("trigger")).first()[0]
            first = last + 1
            if self._left(plans.where(F.col("trigger") == last)).isEmpty():
                return first

    def admitted(self, spark: SparkSession) -> DataFrame:
        """The plans of all batches, with ``batch_id``."""
        plans = table.read_batches(spark, self.plans, _ROUND_SCHEMA + ", batch_id BIGINT")
        return plans.withColumn("batch_id", F.coalesce("trigger", "batch_id")).drop("trigger")


def ticks(seconds: float) -> Callable[[int], int]:
    """A clock that goes on by so many seconds from batch to batch, for runs over a log that is all there."""
    return lambda batch_id: int(batch_id * seconds * 1e6)
