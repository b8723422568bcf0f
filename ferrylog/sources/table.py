"""Logs kept as Parquet.

Layout: one directory per topic and partition, and per segment of offsets if asked for, rows sorted by
offset inside each file. Topic and partition filters prune directories, offset filters skip row groups,
and start offsets prune segments (``operators/segments.py``). A hot partition is written by
many tasks, one per segment of offsets, and each file covers its own range.

A log with segments has a manifest in ``_manifest``, a load for each time it was written. A load is written
after its rows. While rows are appended a mark stands beside the loads, and a log with a mark, as a run that
was cut off leaves it, is read without its manifest until ``write_manifest`` has made it anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrylog.operators.ordered import segment_of
from ferrylog.functions.text import size_of
from ferrylog.operators.segments import LAYOUT_SPAN, SEGMENT, StoredLog, segment_name
from ferrylog.settings import LOG_KEYS
from ferrylog.staging import children, delete, exists, stage

MANIFEST = "_manifest"


def laid_out(log: DataFrame, span: int = LAYOUT_SPAN) -> DataFrame:
    """Rows placed by (topic, part, segment) and sorted by offset.

    Rebalancing lets AQE cut what is larger than its advisory size and join what is smaller, so file
    sizes do not depend on the number of shuffle partitions.
    """
    return (
        log.withColumn("__seg", segment_of("off", span))
        .hint("rebalance", *[F.col(name) for name in (*LOG_KEYS, "__seg")])
        .sortWithinPartitions(*LOG_KEYS, "off")
        .drop("__seg")
    )


def write_log(
    log: DataFrame,
    path: str,
    *,
    mode: str = "errorifexists",
    span: int = LAYOUT_SPAN,
    segments: bool = False,
    ts: str | None = None,
    value: str | None = None,
) -> None:
    """Store a log; with ``segments`` each segment has a directory, column ``seg``, for scans that start anywhere.

    The manifest of such a log has the times of the column ``ts`` and the payload bytes of ``value``, if given.
    """
    if not segments:
        laid_out(log, span).write.partitionBy(*LOG_KEYS).mode(mode).parquet(path)
        return
    spark = log.sparkSession
    appended = mode == "append" and exists(spark, path)
    mark = f"{path}/{MANIFEST}/open"
    if appended:
        folder = spark._jvm.org.apache.hadoop.fs.Path(mark)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    log = log.withColumn(SEGMENT, segment_name(segment_of("off", LAYOUT_SPAN)))
    laid_out(log, span).write.partitionBy(*LOG_KEYS, SEGMENT).mode(mode).parquet(path)
    # of a log that had no manifest so far all rows are summed up, not the new ones alone
    added = appended and any(name.startswith("load-") for name in children(spark, f"{path}/{MANIFEST}"))
    write_manifest(log if added else read_log(spark, path, log.schema), path, ts=ts, value=value, append=added)
    if appended:
        delete(spark, mark)


def write_manifest(
    rows: DataFrame, path: str, *, ts: str | None = None, value: str | None = None, append: bool = False
) -> None:
    """Write the manifest of a log, or, with ``append``, of rows that were added to it."""
    spark = rows.sparkSession
    time = rows.schema[ts].dataType.simpleString() if ts else "timestamp_ntz"
    when = F.col(ts) if ts else F.lit(None).cast(time)
    size = F.sum(size_of(F.col(value))) if value else F.lit(None).cast("bigint")
    found = rows.groupBy(*LOG_KEYS, SEGMENT).agg(
        F.count("*").alias("n"),
        F.min("off").alias("first_off"),
        F.max("off").alias("last_off"),
        F.min(when).alias("min_ts"),
        F.max(when).alias("max_ts"),
        size.alias("bytes"),
    )
    loads = [int(name[5:]) for name in children(spark, f"{path}/{MANIFEST}") if name.startswith("load-")]
    if not append and loads:
        delete(spark, f"{path}/{MANIFEST}")
    found.write.parquet(f"{path}/{MANIFEST}/load-{max(loads, default=-1) + 1 if append else 0}")


def stored_log(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | StoredLog:
    """A log with its manifest, or its rows alone if it has none that is complete.

    The loads are merged and staged once: a small table, of one row per segment.
    """
    rows = read_log(spark, path, schema)
    names = children(spark, f"{path}/{MANIFEST}")
    loads = [f"{path}/{MANIFEST}/{name}" for name in names if name.startswith("load-")]
    if not loads or "open" in names or not all(exists(spark, f"{load}/_SUCCESS") for load in loads):
        return rows
    merged = spark.read.parquet(*loads).groupBy(*LOG_KEYS, SEGMENT).agg(
        F.sum("n").alias("n"),
        F.min("first_off").alias("first_off"),
        F.max("last_off").alias("last_off"),
        F.min("min_ts").alias("min_ts"),
        F.max("max_ts").alias("max_ts"),
        F.sum("bytes").alias("bytes"),
    )
    return StoredLog(rows, spark.read.parquet(*loads) if len(loads) == 1 else stage(merged, "manifest"))


def log_schema(log: DataFrame) -> T.StructType:
    """The schema a written log reads back with: partition columns come last."""
    fields = [f for f in log.schema.fields if f.name not in LOG_KEYS]
    return T.StructType(fields + [log.schema[name] for name in LOG_KEYS])


def read_log(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def stream_log(
    spark: SparkSession, path: str, schema: T.StructType | str, *, bytes_per_trigger: int | None = None
) -> DataFrame:
    """The log directory as a stream; ``bytes_per_trigger`` is the admission limit."""
    reader = spark.readStream.schema(schema)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(bytes_per_trigger))
    return reader.parquet(path)


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch under its id; writing it again replaces it, so a replay adds nothing."""
    rows.write.mode("overwrite").parquet(batch_path(path, batch_id))


def last_batch(spark: SparkSession, path: str, *, upto: int | None = None) -> int:
    """Highest batch id, ``upto`` if given, that was written completely, -1 when there is none."""
    ids = sorted((int(name.split("=")[1]) for name in children(spark, path) if name.startswith("batch_id=")), reverse=True)
    return next((n for n in ids if (upto is None or n <= upto) and exists(spark, f"{batch_path(path, n)}/_SUCCESS")), -1)


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All batches that are written completely, with ``batch_id``; those before the last one are."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    last = last_batch(spark, path)
    rows = reader.option("basePath", path).parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return rows.where(F.col("batch_id") <= last)
