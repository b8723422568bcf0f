"""Rate limit by admission: each trigger takes at most so many bytes of the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylog.functions.text import size_of
from ferrylog.settings import LOG_KEYS
from ferrylog.sources import table
from ferrylog.streaming.runs import run_available


def throttled_stream(
    spark: SparkSession, log_path: str, schema: str, root: str, *, bytes_per_trigger: int, value: str = "value"
) -> DataFrame:
    """Read a stored log at a limited rate; rows and payload bytes of each micro-batch, partition and file.

    Files are admitted whole, one at least. A running job adds a fixed trigger interval, which makes
    the limit one of bytes per time.
    """

    def measure(batch: DataFrame, batch_id: int) -> None:
        size = size_of(F.col(value))
        taken = batch.groupBy(*LOG_KEYS, "file", "file_bytes").agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
        table.write_batch(taken, f"{root}/taken", batch_id)

    stream = table.stream_log(spark, log_path, schema, bytes_per_trigger=bytes_per_trigger).select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_bytes")
    )
    run_available(stream, measure, f"{root}/checkpoint")
    return table.read_batches(spark, f"{root}/taken").select("batch_id", *LOG_KEYS, "n", "bytes", "file", "file_bytes")


def kept_limit(taken: DataFrame, bytes_per_trigger: int) -> DataFrame:
    """Whether each micro-batch stayed within the limit, or took the one file it may always take."""
    files = taken.groupBy("batch_id").agg(F.sum("file_bytes").alias("total"), F.count("*").alias("files"))
    return files.select("batch_id", ((F.col("total") <= bytes_per_trigger) | (F.col("files") == 1)).alias("kept_limit"))


def stored_bytes(spark: SparkSession, log_path: str) -> int:
    """Size of a stored log, as its file system counts it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(log_path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
