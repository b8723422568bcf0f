"""The stream operators run to the end over stored data, as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.functions.text import size_of
from ferrylog.operators import metadata
from ferrylog.plans.inputs import LOG_SCHEMA, Inputs
from ferrylog.plans.mirror import start_positions
from ferrylog.settings import LOG_KEYS
from ferrylog.sources import table
from ferrylog.staging import new_folder, state_of
from ferrylog.streaming.admission import Admission, Bucket, ticks
from ferrylog.streaming.idle import activity_sessions
from ferrylog.streaming.metadata import Refreshing, with_leaders
from ferrylog.streaming.mirror import StreamMirror
from ferrylog.streaming.replay import ReplayFromLog, replay_stream as replayed, tagged
from ferrylog.streaming.runs import run_available
from ferrylog.streaming.throttle import kept_limit, throttled_stream as throttled
from ferrylog.streaming.volume import VolumeLedger, volume_stream as volumes


# Admission limit of the test streams, fixed and small, as the test tables are; a job sets its own.
BYTES_PER_TRIGGER = 64 << 10


def _log_stream(inputs: Inputs, *, limited: bool = False) -> DataFrame:
    """The stored log as a stream, all of it at once or by the admission limit."""
    limit = BYTES_PER_TRIGGER if limited else None
    return table.stream_log(inputs.spark, inputs.log_folder(), LOG_SCHEMA, bytes_per_trigger=limit)


def _whole_result(stream: DataFrame, root: str) -> DataFrame:
    """Run a stream in complete mode and return its last result."""

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/result")

    run_available(stream, replace, f"{root}/checkpoint", mode="complete")
    return stream.sparkSession.read.parquet(f"{root}/result")


def mirror_stream(inputs: Inputs) -> DataFrame:
    """The log arrives in two parts; the mirror runs after each and goes on from its checkpoint."""
    log = inputs.log()
    feed = new_folder(inputs.spark, "feed")
    mirror = StreamMirror(
        root=new_folder(inputs.spark, "mirror"),
        target="sync_",
        value="payload",
        key="sequence",
        as_text=True,
        starts=start_positions(inputs.stored_log(), inputs.checkpoints()),
    )
    middle = log.agg(F.expr("(min(event_id) + max(event_id)) div 2")).first()[0]
    for arrived in (log.where(F.col("event_id") <= middle), log.where(F.col("event_id") > middle)):
        table.write_log(arrived, feed, mode="append")
        mirror.run(table.stream_log(inputs.spark, feed, LOG_SCHEMA))
    rows = mirror.mirrored(inputs.spark)
    return rows.select(*LOG_KEYS, "off", F.col("key").alias("new_key"), F.col("payload").alias("value"))


def admitted_volume(inputs: Inputs) -> DataFrame:
    """Rows and bytes of each partition and trigger under a token bucket of 3,000 bytes a minute, triggered every 45 seconds."""
    admission = Admission(
        inputs.stored_log(), new_folder(inputs.spark, "admitted"), Bucket(3000, 60), size_of(F.col("payload")), inputs.checkpoint_starts()
    )
    admission.run_ahead(inputs.spark, clock=ticks(45))
    taken = admission.admitted(inputs.spark).where("n > 0")
    return taken.select(*LOG_KEYS, "batch_id", "from_off", F.col("position").alias("to_off"), "n", "bytes", "level")


def admitted_mirror(inputs: Inputs) -> DataFrame:
    """The mirror with keys by sequence under a limit: rows come in offset order, trigger after trigger."""
    admission = Admission(
        inputs.stored_log(), new_folder(inputs.spark, "admitted"), Bucket(16 << 10, 60), size_of(F.col("payload")), inputs.checkpoint_starts()
    )
    mirror = StreamMirror(
        root=new_folder(inputs.spark, "mirror"), target="sync_", value="payload", key="sequence", as_text=True
    )
    admission.run_ahead(inputs.spark, mirror.copy, clock=ticks(60))
    rows = mirror.mirrored(inputs.spark)
    return rows.select(*LOG_KEYS, "off", F.col("key").alias("new_key"), F.col("payload").alias("value"))


def throttled_stream(inputs: Inputs) -> DataFrame:
    """Rows and bytes that came through, and whether every micro-batch kept the admission limit."""
    taken = throttled(
        inputs.spark,
        inputs.log_folder(),
        LOG_SCHEMA,
        new_folder(inputs.spark, "throttled"),
        bytes_per_trigger=BYTES_PER_TRIGGER,
        value="payload",
    )
    judged = taken.join(kept_limit(taken, BYTES_PER_TRIGGER), "batch_id")
    return judged.groupBy(*LOG_KEYS).agg(
        F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.bool_and("kept_limit").alias("kept_limit")
    )


def _lateness(log: DataFrame) -> str:
    """How late a row can come when files are read in any order of time: the span of ``ts``, and a second."""
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    micros = log.agg((F.max(time) - F.min(time)).alias("span")).first().span or 0
    return f"{micros // 1_000_000 + 1} seconds"


def volume_stream(inputs: Inputs) -> DataFrame:
    """Updated windows of each micro-batch, the last of each being kept; files come in any order of time.

    The watermark stays behind the first row of the stored log; the query fails if it drops a row all the same.
    """
    root = new_folder(inputs.spark, "volume")
    late = _lateness(table.read_log(inputs.spark, inputs.log_folder(), LOG_SCHEMA))
    stream = volumes(_log_stream(inputs, limited=True), width="1 day", limit=150, late=late, size=size_of(F.col("payload")))
    write = lambda batch, n: table.write_batch(batch, f"{root}/out", n)
    run_available(stream, write, f"{root}/checkpoint", mode="update", none_late=True, small_state=True)
    windows = table.read_batches(inputs.spark, f"{root}/out").groupBy(*LOG_KEYS, "win_start")
    result = windows.agg(*[F.max_by(c, "batch_id").alias(c) for c in ("bytes", "over_limit")])
    return result.withColumn("win_start", F.col("win_start").cast("timestamp_ntz"))


def late_volume(inputs: Inputs) -> DataFrame:
    """The newer half of the log arrives first; of the older half, what is more than three days behind is late."""
    log, feed = inputs.log(), new_folder(inputs.spark, "feed")
    ledger = VolumeLedger(new_folder(inputs.spark, "ledger"), "1 day", "3 days", size_of(F.col("payload")))
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    middle = F.lit(log.select(micros.alias("m")).agg(F.expr("(min(m) + max(m)) div 2")).first()[0])
    for arrived in (log.where(micros >= middle), log.where(micros < middle)):
        table.write_log(arrived, feed, mode="append")
        run_available(table.stream_log(inputs.spark, feed, LOG_SCHEMA), ledger.copy, f"{ledger.root}/checkpoint")
    windows = ledger.windows(inputs.spark, limit=150)
    return windows.withColumn("win_start", F.col("win_start").cast("timestamp_ntz"))


def _failed_stream(inputs: Inputs, root: str) -> DataFrame:
    inputs.failed().write.parquet(f"{root}/failed")
    schema = "topic STRING, part INT, off BIGINT, failed_at TIMESTAMP_NTZ"
    return inputs.spark.readStream.schema(schema).parquet(f"{root}/failed")


def replay_stream(inputs: Inputs) -> DataFrame:
    """Rows kept as state, for a week after their time."""
    root = new_folder(inputs.spark, "replay")

    def keep(batch: DataFrame, batch_id: int) -> None:
        table.write_batch(batch, f"{root}/out", batch_id)

    failed = _failed_stream(inputs, root)
    rows = replayed(_log_stream(inputs), failed, value="payload", ts="ts", keep="7 days")
    run_available(rows, keep, f"{root}/checkpoint")
    out = table.read_batches(inputs.spark, f"{root}/out")
    return out.select(*LOG_KEYS, "off", F.col("value").alias("payload"), "replayed")


def replay_from_log(inputs: Inputs) -> DataFrame:
    """Rows read again from the stored log."""
    root = new_folder(inputs.spark, "replay")
    folder = inputs.log_folder()
    replay = ReplayFromLog(root, lambda spark: table.read_log(spark, folder, LOG_SCHEMA))
    rows = tagged(_log_stream(inputs), _failed_stream(inputs, root))
    run_available(rows, replay.copy, f"{root}/checkpoint")
    return replay.replayed(inputs.spark).select(*LOG_KEYS, "off", "payload", "replayed")


def ordered_replay(inputs: Inputs) -> DataFrame:
    """All failures are known at once, the rows arrive in two parts; each row has its place in the order of emission."""
    log, root = inputs.log(), new_folder(inputs.spark, "replay")
    feed, failed = f"{root}/feed", _failed_stream(inputs, root)
    replay = ReplayFromLog(root, lambda spark: table.read_log(spark, feed, LOG_SCHEMA), numbered=True)
    middle = log.agg(F.expr("(min(event_id) + max(event_id)) div 2")).first()[0]
    for arrived in (log.where(F.col("event_id") <= middle), log.where(F.col("event_id") > middle)):
        table.write_log(arrived, feed, mode="append")
        rows = tagged(table.stream_log(inputs.spark, feed, LOG_SCHEMA), failed)
        run_available(rows, replay.copy, f"{root}/checkpoint")
    return replay.replayed(inputs.spark).select(*LOG_KEYS, "emission", "off", "payload", "replayed")


def idle_stream(inputs: Inputs) -> DataFrame:
    spans = activity_sessions(_log_stream(inputs), gap="240 minutes")
    result = _whole_result(spans, new_folder(inputs.spark, "idle"))
    return result.withColumns(
        {name: F.col(name).cast("timestamp_ntz") for name in ("session_start", "session_end")}
    )


def metadata_refresh_stream(inputs: Inputs) -> DataFrame:
    root = new_folder(inputs.spark, "leaders")

    def load(spark) -> DataFrame:
        states = metadata.parse_states(inputs.topic_state().where("snap = 3"))
        return metadata.partition_leaders(states, metadata.parse_brokers(inputs.brokers()))

    # each micro-batch asks whether the tables that the leaders come from were written again
    sources = [f"{inputs.folder}/{name}.parquet" for name in ("events", "supplier")]
    leaders = Refreshing(load, version=lambda spark: [state_of(spark, path) for path in sources])

    def keep(batch: DataFrame, batch_id: int) -> None:
        named = with_leaders(batch.select(*LOG_KEYS, "off"), leaders.current(batch.sparkSession))
        table.write_batch(named, f"{root}/out", batch_id)

    run_available(_log_stream(inputs, limited=True), keep, f"{root}/checkpoint")
    return table.read_batches(inputs.spark, f"{root}/out").select(*LOG_KEYS, "off", "host")


STREAMS = {
    build.__name__: build
    for build in (
        mirror_stream,
        admitted_volume,
        admitted_mirror,
        throttled_stream,
        volume_stream,
        late_volume,
        replay_stream,
        replay_from_log,
        ordered_replay,
        idle_stream,
        metadata_refresh_stream,
    )
}
