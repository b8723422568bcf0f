"""Column expressions on payloads and keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_LOW_32 = 0xFFFFFFFF


def decode_payload(value: Column) -> Column:
    """Bytes to text; malformed UTF-8 becomes U+FFFD, NULL stays NULL."""
    return F.make_valid_utf8(value.cast("string"))


def size_of(value: Column) -> Column:
    """Payload size in bytes, as bigint so that sums do not overflow; a NULL payload has no bytes."""
    return F.coalesce(F.octet_length(value), F.lit(0)).cast("bigint")


def dump_line(off: Column, text: Column) -> Column:
    """The line a dump prints: ``offset: text``."""
    return F.concat_ws(": ", off.cast("string"), text)


def java_hash(text: Column) -> Column:
    """The hash code a JVM gives a string, as a signed 32-bit int.

    It runs over UTF-16 units. Those of the basic plane are the characters; a text with others counts
    two units for each, read off its hexadecimal form. The sum is kept below 2**32, as ANSI mode
    refuses int overflow.
    """

    def summed(units: Column, number: Callable[[Column], Column]) -> Column:
        step = lambda acc, unit: (acc * 31 + number(unit)).bitwiseAND(F.lit(_LOW_32))
        return F.aggregate(units, F.lit(0).cast("bigint"), step)

    pairs = F.regexp_extract_all(F.hex(F.encode(text, "UTF-16BE")), F.lit("([0-9A-F]{4})"), F.lit(1))
    wide = summed(pairs, lambda unit: F.conv(unit, 16, 10).cast("bigint"))
    plain = summed(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), lambda unit: F.ascii(unit).cast("bigint"))
    unsigned = F.when(text.rlike(r"[\x{10000}-\x{10FFFF}]"), wide).otherwise(plain)
    return F.when(unsigned >= 2**31, unsigned - 2**32).otherwise(unsigned).cast("int")


def hash_partition(key: Column, partitions: int) -> Column:
    """Target partition of a key: its JVM hash modulo the partition count, never negative."""
    return F.pmod(java_hash(key), F.lit(partitions))
