"""Session settings the jobs are written for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STREAM_CONF = {
    # state that does not fit in memory, and what transformWithState requires
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # sessions of one partition are merged before they are shuffled
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    **STREAM_CONF,
}


#: Size of an Arrow batch of texts or arrays between an executor and its Python workers.
BATCH_BYTES = "4m"
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session hold ``BATCH_BYTES``, unless the session has a bound of its own.

    By default a batch holds 10,000 rows of up to 64 MB. Each task has some of them at once, on both sides and
    outside the heap, and allocators keep what they once had. The bound is read when a frame runs, so it stays
    set; rows do not depend on it.
    """
    if _BATCH_KEY not in spark.conf.getAll:
        spark.conf.set(_BATCH_KEY, BATCH_BYTES)


@contextmanager
def stream_conf(spark: SparkSession, state_partitions: int | None = None) -> Iterator[None]:
    """What a stream needs from its session; a stream keeps the settings it was started with.

    ``state_partitions`` is the number of its state stores, by default that of the session's shuffles.
    """
    wanted = STREAM_CONF if state_partitions is None else {**STREAM_CONF, "spark.sql.shuffle.partitions": str(state_partitions)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def build_session(
    name: str = "ferrylog",
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the library's settings; ``shuffle_partitions`` is AQE's starting number.

    Choose it so that a partition of the largest shuffle holds a few hundred megabytes: AQE merges what
    turns out small, but cannot split what an aggregation or a window was given too few partitions for.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
