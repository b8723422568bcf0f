"""``host[:port]`` texts.

Colons at the end count for nothing, so ``h:`` means the default port; any other second colon is
an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_PORT = 9092


def _trimmed(endpoint: Column) -> Column:
    return F.rtrim(endpoint, F.lit(":"))


def host_of(endpoint: Column) -> Column:
    return F.split_part(_trimmed(endpoint), F.lit(":"), F.lit(1))


def port_of(endpoint: Column) -> Column:
    """The port, 9092 when none is written, NULL when it is not a whole number."""
    text = F.split_part(_trimmed(endpoint), F.lit(":"), F.lit(2))
    written = F.when(text.rlike("^[+-]?[0-9]+$"), text).try_cast("int")
    return F.when(text == "", F.lit(DEFAULT_PORT)).otherwise(written)


def is_valid(endpoint: Column) -> Column:
    """A host, a readable port, and no further colon."""
    further = F.split_part(_trimmed(endpoint), F.lit(":"), F.lit(3))
    return (further == "") & (host_of(endpoint) != "") & port_of(endpoint).isNotNull()


def endpoint_text(host: Column, port: Column) -> Column:
    return F.concat_ws(":", host, port.cast("string"))
