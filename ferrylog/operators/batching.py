"""Cutting a log into fetches and send batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.functions.text import size_of
from ferrylog.operators.ordered import SEGMENT_SPAN, accumulate, number_rows
from ferrylog.settings import LOG_KEYS, MIB


def _size(size: Column | str) -> Column:
    return F.coalesce(F.col(size) if isinstance(size, str) else size, F.lit(0)).cast("bigint")


def fetch_budget(
    log: DataFrame, budget: int = MIB, *, size: Column | str | None = None, span: int = SEGMENT_SPAN
) -> DataFrame:
    """Number the fetches of ``budget`` bytes that each row falls into.

    A row belongs to the fetch in whose byte range it starts. The rule is a prefix sum, so it can
    be computed in parallel; filling each fetch greedily would depend on every earlier row.
    """
    size = size_of(F.col("value")) if size is None else _size(size)
    rows = accumulate(log.withColumn("__size", size), sums={"cum_bytes": F.col("__size")}, span=span)
    return rows.withColumn("fetch_id", F.expr(f"(cum_bytes - __size) div {int(budget)}")).drop("__size")


def first_fetch(
    log: DataFrame, budget: int = MIB, *, size: Column | str | None = None, span: int = SEGMENT_SPAN
) -> DataFrame:
    """What one read from the start returns: rows within the byte budget, one row at least.

    Empty payloads at the end of the budget are within it, also when one opens a segment.
    """
    size = size_of(F.col("value")) if size is None else _size(size)
    rows = accumulate(
        log.withColumn("__size", size),
        sums={"__cum": F.col("__size"), "__rn": F.lit(1).cast("bigint")},
        span=span,
        reach=lambda before: (before["__rn"] == 0) | (before["__cum"] <= budget),
    )
    return rows.where((F.col("__cum") <= budget) | (F.col("__rn") == 1)).drop("__cum", "__rn", "__size")


def assign_batches(log: DataFrame, batch_rows: int = 100, *, name: str = "batch_id", span: int = SEGMENT_SPAN) -> DataFrame:
    """Add ``rn`` and the number of the send batch, from 0."""
    return number_rows(log, "rn", span=span).withColumn(name, F.expr(f"(rn - 1) div {int(batch_rows)}"))


def summarize_batches(
    log: DataFrame, batch_rows: int = 100, *, size: Column | str | None = None, span: int = SEGMENT_SPAN
) -> DataFrame:
    """Rows, offset range and bytes of every send batch, the last one being partial."""
    size = size_of(F.col("value")) if size is None else _size(size)
    rows = assign_batches(log.select(*LOG_KEYS, "off", size.alias("__size")), batch_rows, span=span)
    return rows.groupBy(*LOG_KEYS, "batch_id").agg(
        F.count("*").alias("n"),
        F.min("off").alias("first_off"),
        F.max("off").alias("last_off"),
        F.sum("__size").alias("bytes"),
    )


def send_progress(
    log: DataFrame, starts: DataFrame, batch_rows: int = 100, *, span: int = SEGMENT_SPAN
) -> DataFrame:
    """Position after each batch: the start of the read plus the rows sent so far.

    The highest row number in a batch is that count already, so no second pass over batches is
    needed.
    """
    rows = assign_batches(log.select(*LOG_KEYS, "off"), batch_rows, span=span)
    sent = rows.groupBy(*LOG_KEYS, "batch_id").agg(F.max("rn").alias("__sent"))
    return sent.join(starts.select(*LOG_KEYS, "start_off"), list(LOG_KEYS)).select(
        *LOG_KEYS, "batch_id", (F.col("start_off") + F.col("__sent")).alias("sent_to")
    )
