"""Generated messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def named_uuid(seed: str, number: Column) -> Column:
    """UUID-shaped text made from a seed and a number, the same each time it is computed."""
    digest = F.md5(F.concat_ws("-", F.lit(seed), number.cast("string")))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def messages_for(numbers: DataFrame, *, seed: str | None = None) -> DataFrame:
    """One message without a key for each row of ``numbers (id)``.

    The payload is a random UUID, or one made from ``seed`` when a lost task has to give the same
    messages again.
    """
    value = F.uuid() if seed is None else named_uuid(seed, F.col("id"))
    return numbers.select("id", value.alias("value"))


def gen_messages(spark: SparkSession, count: int = 9, *, seed: str | None = None) -> DataFrame:
    """Messages 1 .. ``count``."""
    return messages_for(spark.range(1, count + 1), seed=seed)


def message_stream(spark: SparkSession, *, per_second: int = 1, seed: str | None = None) -> DataFrame:
    """An endless stream of such messages."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return messages_for(rate.select(F.col("value").alias("id")), seed=seed)
