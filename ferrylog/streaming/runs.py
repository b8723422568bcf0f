"""Running a stream over everything that is there now."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ferrylog.session import stream_conf


def run_available(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    mode: str = "append",
    name: str | None = None,
    none_late: bool = False,
    small_state: bool = False,
) -> StreamingQuery:
    """Hand every micro-batch available now to ``on_batch``; return the finished query.

    With ``none_late`` the run fails if the watermark dropped a row. Progress is read while the query
    runs, as ``recentProgress`` keeps the last reports only. ``small_state`` is for streams whose state is sums, not rows:
    each micro-batch commits every state store, however little it holds, so there are no more of them than cores.
    """
    spark = stream.sparkSession
    stores = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism) if small_state else None
    writer = stream.writeStream.foreachBatch(on_batch).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    with stream_conf(spark, stores):
        query = writer.trigger(availableNow=True).start()
    if none_late:
        seen = {}
        done = False
        while not done:
            done = query.awaitTermination(1)
            for p in query.recentProgress:
                seen[p["batchId"]] = max(_dropped(p), seen.get(p["batchId"], 0))
        if seen and len(seen) != max(seen) - min(seen) + 1:
            raise RuntimeError("the progress of some micro-batches is not known, so late rows cannot be ruled out")
        if any(seen.values()):
            raise RuntimeError(f"the watermark dropped {sum(seen.values())} rows")
    else:
        query.awaitTermination()
    return query


def _dropped(progress) -> int:
    return sum(operator.get("numRowsDroppedByWatermark", 0) for operator in progress["stateOperators"])


def late_rows(query: StreamingQuery) -> int:
    """Rows the query dropped because they came after the watermark."""
    return sum(map(_dropped, query.recentProgress))
