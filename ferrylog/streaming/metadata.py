"""A stream joined with metadata that is read again when it has grown old."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ferrylog.settings import LOG_KEYS
from ferrylog.staging import delete, new_folder


class Refreshing:
    """A small table that is loaded again when it is older than ``seconds``, or when ``version`` gives another value.

    A load replaces the table of the one before, whose files are deleted: batches that still read it have to
    be over, as they are when each batch asks for the table and is written before the next one begins.
    """

    def __init__(
        self,
        load: Callable[[SparkSession], DataFrame],
        seconds: float = 60,
        version: Callable[[SparkSession], object] | None = None,
    ):
        self.load = load
        self.seconds = seconds
        self.version = version
        self.loads = 0
        self._loaded_at: float | None = None
        self._seen: object = None
        self._table: DataFrame | None = None
        self._path: str | None = None

    def _outdated(self, spark: SparkSession) -> bool:
        if self._loaded_at is None:
            return True
        if self.version is not None:
            return self.version(spark) != self._seen
        return time.monotonic() - self._loaded_at >= self.seconds

    def current(self, spark: SparkSession) -> DataFrame:
        if self._outdated(spark):
            began, seen = time.monotonic(), self.version(spark) if self.version else None
            rows, path, before = self.load(spark), new_folder(spark, "metadata"), self._path
            # no part of any scope: the table is used by later batches too
            rows.write.parquet(path)
            self._table, self._path = spark.read.schema(rows.schema).parquet(path), path
            self._loaded_at, self._seen = began, seen
            self.loads += 1
            if before:
                delete(spark, before)
        return self._table


def with_leaders(rows: DataFrame, leaders: DataFrame) -> DataFrame:
    """Rows with the address of their partition's leader, NULL while it has none."""
    return rows.join(leaders.select(*LOG_KEYS, "host", "port"), list(LOG_KEYS), "left")
