"""The fact that was in force when a row was written.

Facts about a partition (its leader, say) change while the log grows. Each fact holds from its moment to that of the
next one. These spans are cut at multiples of ``width`` and meet the rows by an equal join on partition and piece of time,
with the span's ends as a further condition. So

* rows are neither sorted nor windowed. While the pieces are few enough for Spark to broadcast they are not moved either, and
  beyond that AQE splits a piece in which most rows lie;
* the next fact is found along segments of time, so a partition with a long history is not sorted in one task;
* a span lists a piece for each ``width`` that it lasts, and a row is compared with the spans of its own piece alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.operators.ordered import accumulate
from ferrylog.settings import LOG_KEYS
from ferrylog.staging import stage

DAY_MICROS = 86_400_000_000

_CELL = "__cell"


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a time without zone, whatever the zone of the session."""
    passed = ts - F.lit("1970-01-01").cast("timestamp_ntz")
    return (passed.cast("interval second").cast("decimal(24, 6)") * 1_000_000).cast("bigint")


def _cell(order: str, width: int) -> Column:
    return F.expr(f"`{order}` div {int(width)}")


def spans_of(
    facts: DataFrame, values: Sequence[str], *, since: str = "since", tie: str | None = None, keys: Sequence[str] = LOG_KEYS,
    width: int = DAY_MICROS,
) -> DataFrame:
    """Each fact with ``until``, the moment of the next one of its partition, NULL for the last.

    Of several facts of one moment the one with the greatest ``tie`` counts, the greatest values without it. Facts
    without a moment are left out; NULL is a value like others.
    """
    value = F.struct(*values)
    order = F.struct(tie) if tie else value
    one = facts.where(F.col(since).isNotNull()).groupBy(*keys, since).agg(F.max_by(value, order).alias("__value"))
    one = stage(one.withColumn("__down", -F.col(since)), "facts")
    spans = accumulate(one, previous={"until": F.col(since)}, keys=keys, order="__down", span=width)
    return spans.select(*keys, since, "until", *[F.col("__value")[name].alias(name) for name in values])


def in_spans(
    rows: DataFrame, spans: DataFrame, values: Sequence[str], *, at: str, since: str = "since", until: str = "until",
    keys: Sequence[str] = LOG_KEYS, width: int = DAY_MICROS,
) -> DataFrame:
    """Rows with the ``values`` of the span ``since <= at < until`` they lie in, NULL where there is none.

    Spans of a partition must not overlap, and only one of them may be without end. All rows stay, each once.
    """
    spans = stage(spans.select(*keys, F.col(since).alias("__since"), F.col(until).alias("__until"), F.struct(*values).alias("__v")), "spans")
    first, last = _cell("__since", width), F.expr(f"(__until - 1) div {int(width)}")
    closed = spans.where("__until > __since").withColumn(_CELL, F.explode(F.sequence(first, last)))
    closed = stage(closed, "cells").select(
        *[F.col(k).alias(f"__c_{k}") for k in keys], _CELL, "__since", "__until", F.col("__v").alias("__closed")
    )
    open_end = spans.where("__until IS NULL").select(
        *[F.col(k).alias(f"__o_{k}") for k in keys], F.col("__since").alias("__from"), F.col("__v").alias("__open")
    )
    same = [F.col(k) == F.col(f"__c_{k}") for k in keys] + [_cell(at, width) == F.col(_CELL)]
    inside = [F.col(at) >= F.col("__since"), F.col(at) < F.col("__until")]
    newest = [F.col(k) == F.col(f"__o_{k}") for k in keys] + [F.col(at) >= F.col("__from")]
    met = rows.join(closed, same + inside, "left").join(stage(open_end, "open"), newest, "left")
    found = F.coalesce("__closed", "__open")
    return met.select(*[F.col(c) for c in rows.columns], *[found[name].alias(name) for name in values])


def as_of(
    rows: DataFrame, facts: DataFrame, values: Sequence[str], *, at: str, since: str = "since", tie: str | None = None,
    keys: Sequence[str] = LOG_KEYS, width: int = DAY_MICROS,
) -> DataFrame:
    """Rows with the values of the last fact at or before ``at``; NULL before the first fact and where ``at`` is NULL.

    ``at`` and ``since`` are whole numbers, such as ``micros`` of a time, or offsets.
    """
    spans = spans_of(facts, values, since=since, tie=tie, keys=keys, width=width)
    return in_spans(rows, spans, values, at=at, since=since, keys=keys, width=width)
