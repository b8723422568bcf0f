"""Volume, idleness, errors and commit pace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.functions.errors import error_action, error_name
from ferrylog.functions.text import size_of
from ferrylog.operators.ordered import SEGMENT_SPAN, accumulate
from ferrylog.settings import LOG_KEYS, MIB


def payload_volume(
    log: DataFrame,
    *,
    width: str = "60 seconds",
    limit: int = 10 * MIB,
    size: Column | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Bytes per partition and aligned time window, flagged when over the limit."""
    size = size_of(F.col("value")) if size is None else size
    windows = log.groupBy(*LOG_KEYS, F.window(F.col(ts), width)).agg(F.sum(size).alias("bytes"))
    return windows.select(
        *LOG_KEYS, F.col("window.start").alias("win_start"), "bytes", (F.col("bytes") > limit).alias("over_limit")
    )


def idle_gaps(log: DataFrame, *, limit_seconds: int = 1200, ts: str = "ts", span: int = SEGMENT_SPAN) -> DataFrame:
    """Rows that came more than ``limit_seconds`` after the row before them in their partition."""
    rows = accumulate(log.select(*LOG_KEYS, "off", ts), previous={"__before": F.col(ts)}, span=span)
    micros = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("__before").cast("timestamp"))
    return (
        rows.withColumn("__gap", micros)
        .where(F.col("__gap") > limit_seconds * 1_000_000)
        .select(*LOG_KEYS, "off", F.expr("__gap div 1000000").alias("gap_seconds"))
    )


def fetch_error_rollup(fetches: DataFrame, *, reset_allowed: bool = True) -> DataFrame:
    """Fetch results by error name and what the reader does about it."""
    named = fetches.withColumn("error", error_name(F.col("error_code")))
    return named.groupBy("part", "error", error_action(F.col("error"), reset_allowed).alias("action")).agg(
        F.count("*").alias("n")
    )


def error_streaks(fetches: DataFrame, *, tolerated: int = 5, span: int = SEGMENT_SPAN) -> DataFrame:
    """Runs of more than ``tolerated`` errors in a row; a success ends a run.

    Errors of one run have the same number of successes before them, so a running count of
    successes names the run, and runs are then summed up with partial aggregation.
    """
    success = (F.col("error_code") == 0).cast("bigint")
    rows = accumulate(
        fetches.select("part", "seq", "error_code"), keys=("part",), order="seq", sums={"__run": success}, span=span
    )
    runs = (
        rows.where(F.col("error_code") != 0)
        .groupBy("part", "__run")
        .agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count("*").alias("n"))
    )
    return runs.where(F.col("n") > tolerated).drop("__run")


def commit_cadence(commits: DataFrame, *, width: str = "60 seconds", ts: str = "ts") -> DataFrame:
    """The position to save for each time window: the last one written in it."""
    saved = commits.groupBy(*LOG_KEYS, F.window(F.col(ts), width)).agg(F.max_by("off", "seq").alias("off"))
    return saved.select(*LOG_KEYS, F.col("window.start").alias("win_start"), "off")
