"""Kafka as source and sink, under the library's column names.

The connector is a separate jar; only ``read_log``, ``stream_log`` and the writers need it. The
option builders are plain functions.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylog.settings import MirrorSettings

# Codes for the ends of a partition in start-offset JSON.
EARLIEST = -2
LATEST = -1

CLIENT_PREFIX = "Client"


def start_offsets_json(starts: Iterable[tuple[str, int, int]]) -> str:
    """``{"topic": {"partition": offset}}`` for the connector's ``startingOffsets``."""
    chosen: dict[str, dict[str, int]] = {}
    for topic, part, off in starts:
        chosen.setdefault(topic, {})[str(part)] = int(off)
    return json.dumps(chosen, sort_keys=True)


def start_options(settings: MirrorSettings) -> dict[str, str]:
    """Where a reader without a checkpoint begins."""
    if settings.starting in ("earliest", "latest"):
        return {"startingOffsets": settings.starting}
    millis = int(_as_timestamp(settings.starting) * 1000)
    return {"startingTimestamp": str(millis), "startingOffsetsByTimestampStrategy": "latest"}


def _as_timestamp(text: str) -> float:
    from datetime import datetime, timezone

    at = datetime.fromisoformat(text)
    return (at if at.tzinfo else at.replace(tzinfo=timezone.utc)).timestamp()


def read_options(
    settings: MirrorSettings,
    servers: str,
    *,
    assign: dict[str, list[int]] | None = None,
    starts: Iterable[tuple[str, int, int]] | None = None,
    rows_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Connector options for a read.

    ``min_partitions`` lets the connector split a large log partition between tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "kafka.client.id": f"{CLIENT_PREFIX}_{settings.client_id}",
        "kafka.max.partition.fetch.bytes": str(settings.max_bytes),
        "failOnDataLoss": "true" if settings.on_out_of_range == "fail" else "false",
    }
    if assign:
        options["assign"] = json.dumps(assign, sort_keys=True)
    else:
        options["subscribe"] = settings.source
    options |= start_options(settings) if starts is None else {"startingOffsets": start_offsets_json(starts)}
    if rows_per_trigger:
        options["maxOffsetsPerTrigger"] = str(rows_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def write_options(settings: MirrorSettings, servers: str) -> dict[str, str]:
    """Connector options for a write: leader acknowledgement, batches of the configured size."""
    options = {"kafka.bootstrap.servers": servers, "kafka.acks": "1"}
    if settings.target:
        options["topic"] = settings.target
    return options


def as_log(source: DataFrame) -> DataFrame:
    """The connector's columns under the log's names."""
    return source.select(
        "key",
        "value",
        "topic",
        F.col("partition").alias("part"),
        F.col("offset").alias("off"),
        F.col("timestamp").alias("ts"),
    )


def as_records(
    log: DataFrame,
    *,
    encode: Callable[[Column], Column] | None = None,
    partition: str | None = None,
) -> DataFrame:
    """A log as the sink's columns; ``encode`` turns the value into bytes or text."""
    value = F.col("value") if encode is None else encode(F.col("value"))
    columns = ["topic", "key", value.alias("value")]
    if partition:
        columns.append(F.col(partition).alias("partition"))
    return log.select(*columns)


def read_log(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return as_log(spark.read.format("kafka").options(**options).load())


def stream_log(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return as_log(spark.readStream.format("kafka").options(**options).load())


def write_records(records: DataFrame, options: dict[str, str]) -> None:
    records.write.format("kafka").options(**options).save()


def stream_records(records: DataFrame, options: dict[str, str], checkpoint: str):
    """Start an at-least-once stream into the target topic."""
    return (
        records.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()
    )
