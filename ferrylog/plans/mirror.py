"""The mirror as one batch job: resume, scan, decode, re-key, rename, cut into send batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.functions.text import decode_payload
from ferrylog.operators import log as log_ops, offsets
from ferrylog.operators.batching import assign_batches
from ferrylog.operators.ordered import SEGMENT_SPAN
from ferrylog.operators.segments import StoredLog, rows_of
from ferrylog.settings import LOG_KEYS, MirrorSettings
from ferrylog.sources import table
from ferrylog.sources.checkpoints import CheckpointStore
from ferrylog.staging import scratch, stage


def _configured(log: DataFrame | StoredLog, bounds: DataFrame, starting: str, ts: str) -> DataFrame:
    """Bounds with the configured start as ``configured``."""
    if starting in ("earliest", "latest"):
        return bounds.withColumn("configured", F.col(starting))
    at = F.lit(starting).cast(rows_of(log).schema[ts].dataType)
    timed = offsets.offset_at_time(log, at, ts=ts).withColumnRenamed("off", "configured")
    return bounds.join(timed, list(LOG_KEYS))


def start_positions(
    log: DataFrame | StoredLog,
    checkpoints: DataFrame,
    *,
    starting: str = "earliest",
    force: bool = False,
    out_of_range: str = "keep",
    ts: str = "ts",
) -> DataFrame:
    """Start offset of every partition, staged for joining with the log.

    ``starting`` is ``earliest``, ``latest`` or a timestamp text; it serves partitions without a usable
    saved offset, and all of them when ``force`` is set. A saved offset past the end is kept, which
    reads nothing until the log has grown that far; with ``out_of_range`` it is set to ``earliest``
    or ``latest``, or the job is made to ``fail``.
    """
    bounds = offsets.offset_bounds(log)
    saved = checkpoints.where(F.lit(not force))
    starts = offsets.resolve_start(_configured(log, bounds, starting, ts), saved, start="configured")
    if out_of_range != "keep":
        repaired = offsets.out_of_range(bounds, starts, policy=out_of_range, position="start_off")
        starts = repaired.select(*LOG_KEYS, F.col("reset_off").alias("start_off"))
    return stage(starts, "starts")


def resume(log: DataFrame | StoredLog, checkpoints: DataFrame, **start_options) -> DataFrame:
    """The rows that a run starting from the saved offsets has to copy."""
    return log_ops.scan_from(log, start_positions(log, checkpoints, **start_options))


def mirror_batch(
    log: DataFrame | StoredLog,
    checkpoints: DataFrame,
    *,
    target: str,
    value: str = "value",
    batch_rows: int = 100,
    key: str = "keep",
    as_text: bool = False,
    span: int = SEGMENT_SPAN,
    **start_options,
) -> DataFrame:
    """Rows for the target topic with their send batch.

    ``target`` is the new topic name, or a prefix of the old one when it ends in ``_``.
    ``key="sequence"`` replaces the source key by the count 1 .. ``batch_rows`` along the
    partition. ``as_text`` decodes values; bytes are copied unchanged otherwise. Other options are those
    of ``start_positions``.
    """
    if key not in ("keep", "sequence"):
        raise ValueError(f"key must be 'keep' or 'sequence', not {key!r}")
    rows = assign_batches(resume(log, checkpoints, **start_options), batch_rows, span=span)
    if key == "sequence":
        rows = rows.withColumn("key", log_ops.sequence_key(F.col("rn"), batch_rows))
    if as_text:
        rows = rows.withColumn(value, decode_payload(F.col(value)))
    return log_ops.retopic(rows, target_topic(target)).drop("rn")


def mirror_job(log: DataFrame, checkpoints: DataFrame, settings: MirrorSettings, **options) -> DataFrame:
    """``mirror_batch`` for the source and target that the settings name."""
    if settings.target is None:
        raise ValueError("the settings name no target")
    reset = settings.starting if settings.starting in ("earliest", "latest") else "earliest"
    return mirror_batch(
        log.where(F.col("topic") == settings.source),
        checkpoints,
        target=settings.target,
        batch_rows=settings.batch_rows,
        starting=settings.starting,
        force=settings.force_start,
        out_of_range="fail" if settings.on_out_of_range == "fail" else reset,
        **options,
    )


def run_mirror(
    log: DataFrame | StoredLog, store: CheckpointStore, path: str, settings: MirrorSettings, *, owner: str, **options
) -> int:
    """One run of the batch mirror: resume from the saved positions, copy, then save the positions reached.

    Rows are written under the number of the snapshot that their positions are saved in, by replacement: a run
    that was cut off and is begun again by the same ``owner`` writes the same rows to the same place. The
    number is claimed before anything is written, so of two runs that began from one snapshot the second
    one fails (``StaleWriter``) before it has copied a row. Returns the new snapshot's number.
    """
    spark = rows_of(log).sparkSession
    begun = store.latest(spark)
    store.claim(spark, begun + 1, owner)
    mine = rows_of(log).where(F.col("topic") == settings.source)
    source = StoredLog(mine, log.segments.where(F.col("topic") == settings.source)) if isinstance(log, StoredLog) else mine
    with scratch(spark):
        saved = store.read(spark, begun).where(F.col("job_id") == settings.client_id)
        bounds = offsets.offset_bounds(source)
        starts = start_positions(source, saved, starting=settings.starting, force=settings.force_start)
        copied = mirror_batch(source, saved, target=settings.target, batch_rows=settings.batch_rows, starting=settings.starting,
                              force=settings.force_start, **options)
        table.write_batch(table.laid_out(copied), path, begun + 1)
        # the end of the log that was read; a start behind it is kept
        ends = bounds.join(starts.select(*LOG_KEYS, "start_off"), list(LOG_KEYS))
        reached = ends.select(*LOG_KEYS, F.lit(begun + 1).cast("bigint").alias("seq"), F.greatest("latest", "start_off").alias("off"))
        return store.commit(reached, begun, job_id=settings.client_id, owner=owner)


def target_topic(target: str):
    """Expression for the target topic; a name ending in ``_`` is put before the source topic."""
    return F.concat(F.lit(target), F.col("topic")) if target.endswith("_") else F.lit(target)


def audit(source: DataFrame, target: DataFrame) -> DataFrame:
    """Offsets on one side only: ``missing`` from the target, or ``extra`` in it."""
    key = [*LOG_KEYS, "off"]
    missing = source.select(*key).join(target.select(*key), key, "left_anti").withColumn("problem", F.lit("missing"))
    extra = target.select(*key).join(source.select(*key), key, "left_anti").withColumn("problem", F.lit("extra"))
    return missing.unionByName(extra)


def write_and_read_back(rows: DataFrame, path: str) -> DataFrame:
    """Store a log and read it again, with the columns in the order given."""
    table.write_log(rows, path)
    return table.read_log(rows.sparkSession, path, table.log_schema(rows)).select(rows.columns)
