"""Running totals and previous values along the offsets of a partition, spread over many tasks.

A plain window over (topic, part) would sort one whole log partition in one task. Here a partition
is cut into segments of ``span`` consecutive offsets. Offsets are unique, so a segment never holds
more than ``span`` rows whatever the skew:

1. each segment is summarised by a partial aggregation that reads only what is summed, and the
   summaries, one row per segment, are staged;
2. the summaries are accumulated in segment order. The range of segment numbers was observed while
   they were written: up to ``FANOUT`` of them fit a window, more are cut into segments again;
3. rows are windowed inside their segment and shifted by what came before it.

Rows go through one shuffle, on (keys, segment). The window and the join share it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ferrylog.operators.segments import LAYOUT_SPAN, SEGMENT, only_segments, segment_name
from ferrylog.settings import LOG_KEYS
from ferrylog.staging import stage

SEGMENT_SPAN = 1 << 14
FANOUT = 1 << 16

_SEG = "__seg"


def segment_of(order: str, span: int = SEGMENT_SPAN) -> Column:
    """Number of the segment that holds an offset."""
    return F.expr(f"`{order}` div {int(span)}")


def _summaries(rows, keys, order, sums, previous, span) -> DataFrame:
    aggs = [F.sum(col).alias(f"__sum_{name}") for name, col in sums.items()]
    aggs += [F.max_by(col, F.col(order)).alias(f"__last_{name}") for name, col in previous.items()]
    return rows.groupBy(*keys, segment_of(order, span).alias(_SEG)).agg(*aggs)


def _windowed(rows, keys, order, sums, previous) -> DataFrame:
    in_order = Window.partitionBy(*keys).orderBy(order)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    made = {name: F.sum(col).over(so_far) for name, col in sums.items()}
    made |= {name: F.lag(col).over(in_order) for name, col in previous.items()}
    return rows.withColumns(made)


def _before_each(rows, keys, order, sums, previous, span, fanout) -> DataFrame:
    """Per segment: the totals before it and the last values before it."""
    seen = Observation()
    summaries = _summaries(rows, keys, order, sums, previous, span)
    summaries = stage(
        summaries.observe(seen, F.min(_SEG).alias("low"), F.max(_SEG).alias("high")), "segments"
    )
    widest = (seen.get.get("high") or 0) - (seen.get.get("low") or 0) + 1
    totals = {f"__to_{name}": F.col(f"__sum_{name}") for name in sums}
    carries = {f"__carry_{name}": F.col(f"__last_{name}") for name in previous}
    if widest <= fanout:
        scanned = _windowed(summaries, keys, _SEG, totals, carries)
    else:
        scanned = accumulate(
            summaries, sums=totals, previous=carries, keys=keys, order=_SEG, span=fanout, fanout=fanout
        )
    return scanned.select(
        *keys,
        _SEG,
        *[(F.col(f"__to_{n}") - F.col(f"__sum_{n}")).alias(f"__base_{n}") for n in sums],
        *[f"__carry_{n}" for n in previous],
    )


def accumulate(
    rows: DataFrame,
    *,
    sums: Mapping[str, Column] | None = None,
    previous: Mapping[str, Column] | None = None,
    keys: Sequence[str] = LOG_KEYS,
    order: str = "off",
    span: int = SEGMENT_SPAN,
    fanout: int = FANOUT,
    reach: Callable[[Mapping[str, Column]], Column] | None = None,
) -> DataFrame:
    """Add running totals (``sums``, this row included) and values of the row before (``previous``).

    ``order`` must be a whole number, unique inside ``keys``. ``reach`` gets the totals before a
    segment and tells whether the segment is wanted at all; segments it rejects are dropped before
    their rows are shuffled, which suits questions about the head of each partition.
    """
    sums, previous = dict(sums or {}), dict(previous or {})
    before = _before_each(rows, keys, order, sums, previous, span, fanout)
    level = f"__level{rows.columns.count(_SEG)}"
    before = before.withColumnRenamed(_SEG, level)
    rows = rows.withColumn(level, segment_of(order, span))
    if reach is not None:
        wanted = before.where(reach({name: F.col(f"__base_{name}") for name in sums}))
        wanted = stage(wanted, "reach")
        if tuple(keys) == LOG_KEYS and LAYOUT_SPAN % span == 0:  # a segment lies in one directory
            rows = only_segments(rows, wanted.withColumn(SEGMENT, segment_name(F.expr(f"{level} div {LAYOUT_SPAN // span}"))))
        rows = rows.join(wanted, [*keys, level])

    if previous:
        rows = rows.withColumn("__nth", F.row_number().over(Window.partitionBy(*keys, level).orderBy(order)))
    rows = _windowed(rows, [*keys, level], order, sums, previous)
    if reach is None:
        rows = rows.join(before, [*keys, level])

    shifted = {name: F.col(name) + F.col(f"__base_{name}") for name in sums}
    shifted |= {
        name: F.when(F.col("__nth") == 1, F.col(f"__carry_{name}")).otherwise(F.col(name)) for name in previous
    }
    return rows.withColumns(shifted).drop(
        level, "__nth", *[f"__base_{n}" for n in sums], *[f"__carry_{n}" for n in previous]
    )


def number_rows(rows: DataFrame, name: str = "rn", **options) -> DataFrame:
    """Count rows 1, 2, 3, ... along the offsets of each partition."""
    return accumulate(rows, sums={name: F.lit(1).cast("bigint")}, **options)
