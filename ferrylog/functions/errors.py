"""Fetch error codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error names in the order of their codes, 0 first.
ERROR_NAMES = (
    "NO_ERROR",
    "OFFSET_OUT_OF_RANGE",
    "INVALID_MESSAGE",
    "UNKNOWN_TOPIC_OR_PARTITION",
    "INVALID_FETCH_SIZE",
    "LEADER_NOT_AVAILABLE",
    "NOT_LEADER_FOR_PARTITION",
    "REQUEST_TIMED_OUT",
    "BROKER_NOT_AVAILABLE",
    "REPLICA_NOT_AVAILABLE",
    "MESSAGE_SIZE_TOO_LARGE",
    "STALE_CONTROLLER_EPOCH",
    "OFFSET_METADATA_TOO_LARGE",
)
UNKNOWN = "UNKNOWN"


def error_name(code: Column) -> Column:
    """Name of a code; any code outside the list is UNKNOWN."""
    return F.coalesce(F.get(F.array(*map(F.lit, ERROR_NAMES)), code), F.lit(UNKNOWN))


def error_action(name: Column, reset_allowed: bool = True) -> Column:
    """What a reader does: ``ok``, ``reset`` its position, or ``fail``."""
    action = F.when(name == "NO_ERROR", "ok")
    if reset_allowed:
        action = action.when(name == "OFFSET_OUT_OF_RANGE", "reset")
    return action.otherwise("fail")
