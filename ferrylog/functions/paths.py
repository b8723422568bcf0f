"""Node paths and identifiers of the coordination tree, both ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The paths and prefixes that existing trees use.
OFFSETS_ROOT = "/consumers/demo/offsets"
TOPICS_ROOT = "/brokers/topics"
BROKERS_ROOT = "/brokers/ids"
SYNC_TOPICS_ROOT = "/sync/topics/ids"
CLIENT_PREFIX = "Client"
PARTITION_PREFIX = "partition"

_OFFSET = f"^{OFFSETS_ROOT}/([^/]+)/([0-9]+)$"
_STATE = f"^{TOPICS_ROOT}/([^/]+)/partitions/([0-9]+)/state$"
_BROKER = f"^{BROKERS_ROOT}/([0-9]+)$"


def offset_path(topic: Column, part: Column) -> Column:
    return F.concat_ws("/", F.lit(OFFSETS_ROOT), topic, part.cast("string"))


def partitions_path(topic: Column) -> Column:
    return F.concat_ws("/", F.lit(TOPICS_ROOT), topic, F.lit("partitions"))


def state_path(topic: Column, part: Column) -> Column:
    return F.concat_ws("/", partitions_path(topic), part.cast("string"), F.lit("state"))


def broker_path(broker_id: Column) -> Column:
    return F.concat_ws("/", F.lit(BROKERS_ROOT), broker_id.cast("string"))


def sync_topic_path(topic: Column) -> Column:
    return F.concat_ws("/", F.lit(SYNC_TOPICS_ROOT), topic)


def client_id(client: Column | str, part: Column) -> Column:
    client = F.lit(client) if isinstance(client, str) else client
    return F.concat_ws("_", F.lit(CLIENT_PREFIX), client, part.cast("string"))


def partition_id(part: Column) -> Column:
    return F.concat_ws("_", F.lit(PARTITION_PREFIX), part.cast("string"))


def kind_of(path: Column) -> Column:
    """``offset``, ``state``, ``broker`` or ``other``."""
    return (
        F.when(path.rlike(_OFFSET), "offset")
        .when(path.rlike(_STATE), "state")
        .when(path.rlike(_BROKER), "broker")
        .otherwise("other")
    )


def topic_of(path: Column) -> Column:
    return F.when(path.rlike(_OFFSET), F.regexp_extract(path, _OFFSET, 1)).when(
        path.rlike(_STATE), F.regexp_extract(path, _STATE, 1)
    )


def part_of(path: Column) -> Column:
    text = F.when(path.rlike(_OFFSET), F.regexp_extract(path, _OFFSET, 2)).when(
        path.rlike(_STATE), F.regexp_extract(path, _STATE, 2)
    )
    return text.try_cast("int")


def broker_id_of(path: Column) -> Column:
    return F.when(path.rlike(_BROKER), F.regexp_extract(path, _BROKER, 1)).try_cast("int")
