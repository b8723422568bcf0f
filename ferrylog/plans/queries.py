"""Every operator as a query on a data folder: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylog.functions import paths
from ferrylog.functions.text import decode_payload, dump_line, size_of
from ferrylog.operators import asof, batching, chains, log as log_ops, metadata, monitor, offsets, ranges, replay
from ferrylog.plans import mirror, streams
from ferrylog.plans.inputs import SNAPSHOTS, Inputs
from ferrylog.settings import LOG_KEYS
from ferrylog.sources import generate, kafka
from ferrylog.sources.checkpoints import CheckpointStore
from ferrylog.staging import new_folder, stage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Inputs(spark, folder))

    QUERIES[build.__name__] = run
    return run


def _payload_size():
    return size_of(F.col("payload"))


def _bounds(inputs: Inputs) -> DataFrame:
    return offsets.offset_bounds(inputs.stored_log())


def _states(inputs: Inputs, snap: int = 3) -> DataFrame:
    return metadata.parse_states(inputs.topic_state().where(F.col("snap") == snap))


def _leaders(inputs: Inputs) -> DataFrame:
    return metadata.partition_leaders(_states(inputs), metadata.parse_brokers(inputs.brokers()))


# --- scans, sources, sinks


@query
def log_scan(inputs):
    return mirror.resume(inputs.stored_log(), inputs.checkpoints()).select(*LOG_KEYS, "off", "payload")


@query
def bounded_read(inputs):
    return log_ops.bounded_read(inputs.log(), 20).select(*LOG_KEYS, "off", "payload")


@query
def earliest_dump(inputs):
    """The rows of the first fetch are found by size alone; only then are their texts looked up."""
    sizes = inputs.doclog().select(*LOG_KEYS, "off", "doc_id", "n_bytes")
    head = stage(batching.first_fetch(sizes, 65_536, size="n_bytes"), "head")
    line = dump_line(F.col("off"), F.col("text"))
    rows = inputs.table("documents").select("doc_id", "text").join(head, "doc_id")
    return rows.select(*LOG_KEYS, "off", "n_bytes", F.char_length(line).cast("bigint").alias("line_len"))


@query
def mirror_sink(inputs):
    rows = mirror.resume(inputs.stored_log(), inputs.checkpoints())
    rows = rows.select(*LOG_KEYS, "off", F.col("payload").alias("value"))
    return mirror.write_and_read_back(rows, new_folder(inputs.spark, "mirror"))


@query
def checkpoint_read(inputs):
    return metadata.checkpoint_read(inputs.nodes())


@query
def checkpoint_upsert(inputs):
    return metadata.checkpoint_upsert(inputs.commits())


@query
def checkpoint_deltas(inputs):
    """Four saves, each a delta, with a base after the third: the second snapshot and the last one."""
    commits = inputs.commits()
    low, span = commits.agg(F.min("seq"), F.max("seq") - F.min("seq") + 1).first()
    store = CheckpointStore(new_folder(inputs.spark, "saved"))
    for n in range(4):
        store.save(commits.where((F.col("seq") - low) * 4 >= n * span).where((F.col("seq") - low) * 4 < (n + 1) * span), n, job_id="job")
        if n == 2:
            store.positions.compact(inputs.spark)
    states = [store.read(inputs.spark, n).withColumn("snapshot", F.lit(n)) for n in (1, 3)]
    return states[0].unionByName(states[1])


@query
def registry_deltas(inputs):
    """The registry grows by the registrations of each snapshot of leaders, and is compacted on the way."""
    events = stage(metadata.registrations(metadata.parse_states(inputs.topic_state())), "registrations")
    registry = metadata.registry(new_folder(inputs.spark, "registry"), compact_every=2)
    for snap in range(SNAPSHOTS):
        metadata.register(registry, events.where(F.expr(f"seq div 2 = {snap}")), snap)
    return metadata.held_partitions(registry.read(inputs.spark))


@query
def znode_json(inputs):
    return metadata.node_json(inputs.nodes())


@query
def gen_messages(inputs):
    numbers = inputs.table("events").select(F.col("event_id").alias("id"))
    return generate.messages_for(numbers, seed="sync")


@query
def node_writes(inputs):
    """What a job writes to the tree: its positions, plain and as JSON with its name, and states and brokers as JSON."""
    saved = inputs.checkpoints()
    states = metadata.parse_states(inputs.topic_state().where("snap = 1"))  # one has no leader
    body = metadata.state_json(F.col("leader"), F.col("isr"), epoch=F.lit(1))
    brokers = metadata.parse_brokers(inputs.brokers())
    parts = [
        metadata.checkpoint_nodes(saved).withColumn("form", F.lit("plain")),
        metadata.checkpoint_job_nodes(saved).withColumn("form", F.lit("job")),
        states.select(paths.state_path(F.col("topic"), F.col("part")).alias("path"), body.alias("data"), F.lit("state").alias("form")),
        brokers.select(
            paths.broker_path(F.col("broker_id")).alias("path"),
            metadata.broker_json(F.col("host"), F.col("port")).alias("data"),
            F.lit("broker").alias("form"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def node_reads(inputs):
    """Positions with the job that saved them, read back from the JSON form."""
    return metadata.checkpoint_job_read(metadata.checkpoint_job_nodes(inputs.checkpoints()))


# --- projections, filters, scalar work


@query
def payload_decode(inputs):
    raw = F.col("payload").cast("binary")
    return inputs.log().select(
        *LOG_KEYS, "off", decode_payload(raw).alias("text"), size_of(raw).alias("n_bytes")
    )


@query
def drop_old_offsets(inputs):
    saved = stage(inputs.checkpoints(), "checkpoints")
    return log_ops.drop_old(inputs.stored_log(), saved).select(*LOG_KEYS, "off")


@query
def retopic(inputs):
    renamed = log_ops.retopic(inputs.log(), mirror.target_topic("sync_"), source_name="src_topic")
    return renamed.select("src_topic", *LOG_KEYS, "off")


@query
def rekey_sequence(inputs):
    return log_ops.rekey_sequence(inputs.log().select(*LOG_KEYS, "off"))


@query
def hash_partition(inputs):
    return log_ops.with_target_partition(inputs.log(), 8, key="payload").select("event_id", "jhash", "target_part")


@query
def partition_by(inputs):
    """The partitioner is replaced: the last digit of the event's id, by a rule of the caller's."""
    log = inputs.log().withColumn("key", F.col("event_id").cast("string"))
    rule = lambda key: (F.right(key, F.lit(1)).cast("int") % 3).cast("int")
    return log_ops.with_target_partition(log, 8, partition_by=rule).select("event_id", "jhash", "target_part")


@query
def encode(inputs):
    """Rows as the records of a topic; the caller's encoder makes the value."""
    log = log_ops.retopic(inputs.log(), mirror.target_topic("sync_")).withColumn("key", F.col("event_id").cast("string"))
    log = log.withColumn("value", F.col("payload"))
    wrapped = lambda value: F.concat(F.lit("{"), F.octet_length(value).cast("string"), F.lit("}"), value)
    return kafka.as_records(log, encode=wrapped, partition="part")


@query
def next_offset(inputs):
    return offsets.next_offset(inputs.stored_log(), inputs.checkpoints())


@query
def endpoint_parse(inputs):
    return metadata.endpoint_parse(inputs.endpoint_lists())


@query
def checkpoint_paths(inputs):
    return metadata.node_paths(inputs.nodes())


# --- joins


@query
def partition_leaders(inputs):
    return _leaders(inputs)


@query
def resolve_start(inputs):
    return offsets.resolve_start(_bounds(inputs), inputs.checkpoints())


@query
def resolve_start_job(inputs):
    bounds = _bounds(inputs).withColumn("start_mode", F.explode(F.array(F.lit("earliest"), F.lit("latest"))))
    start = F.when(F.col("start_mode") == "earliest", F.col("earliest")).otherwise(F.col("latest"))
    chosen = offsets.resolve_start_job(
        bounds, inputs.checkpoints(), job_id="job-a", force=True, start=start, max_behind=300
    )
    return chosen.select("start_mode", *LOG_KEYS, "start_off", "reason")


@query
def replay_failed(inputs):
    log = inputs.stored_log()
    starts = offsets.resolve_start(offsets.offset_bounds(log), inputs.checkpoints())
    return replay.replay_failed(log, inputs.failed().drop("failed_at"), starts).select(*LOG_KEYS, "off", "payload", "replayed")


@query
def replica_hosts(inputs):
    return metadata.replica_hosts(_states(inputs), metadata.parse_brokers(inputs.brokers()))


@query
def assignment_diff(inputs):
    return metadata.assignment_diff(
        metadata.assignments(_states(inputs, 1)), metadata.assignments(_states(inputs, 2))
    )


@query
def restart_flags(inputs):
    """Which brokers have to restart their readers after each snapshot."""
    steps = []
    for snap in range(1, SNAPSHOTS):
        diff = metadata.assignment_diff(
            metadata.assignments(_states(inputs, snap - 1)), metadata.assignments(_states(inputs, snap))
        )
        steps.append(metadata.assignment_changed(diff).withColumn("snap", F.lit(snap)))
    return reduce(DataFrame.unionByName, steps)


@query
def accepted_leaders(inputs):
    """A reader whose fetch failed looks at the next snapshots, three at most, until it accepts a leader."""
    brokers = metadata.parse_brokers(inputs.brokers()).select(F.col("broker_id").alias("leader"), "host")
    looked = metadata.parse_states(inputs.topic_state()).join(stage(brokers, "brokers"), "leader", "left")
    failed = looked.where("snap = 0").select(*LOG_KEYS, F.col("host").alias("old_host"))
    tries = looked.where("snap > 0").select(*LOG_KEYS, (F.col("snap") - 1).alias("try_no"), "host")
    return metadata.accept_leader(tries.join(stage(failed, "failed"), list(LOG_KEYS)))


@query
def row_leaders(inputs):
    """Each row with the broker that led its partition when it was written, as leaders move."""
    brokers = metadata.parse_brokers(inputs.brokers()).select(F.col("broker_id").alias("leader"), "host")
    reports = inputs.leader_reports().withColumn("since", asof.micros(F.col("ts")))
    hosted = reports.join(stage(brokers, "brokers"), "leader", "left").withColumn("reported", F.col("event_id"))
    rows = inputs.log().select(*LOG_KEYS, "off", asof.micros(F.col("ts")).alias("at"))
    return asof.as_of(rows, hosted, ["reported", "leader", "host"], at="at", tie="event_id").drop("at")


# --- sets of offsets


def _done(inputs: Inputs) -> DataFrame:
    """Finished one by one, or lying before the saved position."""
    saved = _bounds(inputs).join(inputs.checkpoints(), list(LOG_KEYS))
    return ranges.union(ranges.of_offsets(inputs.finished()), ranges.below(saved))


@query
def open_ranges(inputs):
    """Runs of offsets that were read and have not finished."""
    return ranges.difference(ranges.of_offsets(inputs.log()), _done(inputs))


@query
def inflight_ranges(inputs):
    """Finishes out of order: how much is open, and which position is safe to save."""
    return ranges.inflight(ranges.of_offsets(inputs.log()), _done(inputs))


@query
def failed_and_done(inputs):
    """Of the failed offsets, which have finished since and need no replay."""
    return ranges.contained(inputs.failed().drop("failed_at"), _done(inputs), "done")


# --- aggregations


@query
def offset_bounds(inputs):
    return _bounds(inputs)


@query
def offset_at_time(inputs):
    return offsets.offset_at_time(inputs.stored_log(), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))


@query
def default_offset(inputs):
    bounds = _bounds(inputs).withColumn("force", F.explode(F.array(F.lit(True), F.lit(False))))
    return offsets.default_offset(bounds, F.col("force")).select(*LOG_KEYS, "force", "off")


@query
def partition_count(inputs):
    return metadata.partition_count(metadata.parse_states(inputs.topic_state()))


@query
def partitions_led_by(inputs):
    return metadata.partitions_led_by(_states(inputs))


@query
def broker_partitions(inputs):
    states = metadata.parse_states(inputs.topic_state())
    return metadata.broker_partitions(metadata.registrations(states))


@query
def broker_id_for_host(inputs):
    brokers = metadata.read_nodes(inputs.nodes()).where("kind = 'broker'")
    return metadata.broker_id_for_host(brokers, "node1")


@query
def payload_volume(inputs):
    return monitor.payload_volume(inputs.log(), width="1 day", limit=150, size=_payload_size())


@query
def fetch_error_rollup(inputs):
    return monitor.fetch_error_rollup(inputs.fetches())


# --- windows along the offsets


@query
def fetch_budget(inputs):
    rows = batching.fetch_budget(inputs.doclog(), 65_536, size="n_bytes")
    return rows.select(*LOG_KEYS, "off", "cum_bytes", "fetch_id")


@query
def greedy_fetches(inputs):
    """Fetches filled to their budget, each from where the last one ended."""
    return chains.greedy_fetches(inputs.doclog().select(*LOG_KEYS, "off", "n_bytes"), 65_536, size="n_bytes")


@query
def spaced_saves(inputs):
    """A position is saved once six hours have passed since the last save."""
    commits = inputs.commits().withColumn("at", asof.micros(F.col("ts")))
    return chains.saves(commits, 6 * 3_600_000_000, at=F.col("at")).select(*LOG_KEYS, "seq", "off", "ts")


@query
def batch_by_count(inputs):
    return batching.summarize_batches(inputs.log(), 100, size=_payload_size())


@query
def emit_state(inputs):
    log = inputs.stored_log()
    bounds = offsets.offset_bounds(log)
    return replay.emit_state(log, offsets.resolve_start(bounds, inputs.checkpoints()), bounds, inputs.partitions())


@query
def send_progress(inputs):
    log = inputs.stored_log()
    starts = mirror.start_positions(log, inputs.checkpoints())
    return batching.send_progress(log_ops.scan_from(log, starts), starts, 100)


@query
def idle_gaps(inputs):
    return monitor.idle_gaps(inputs.log(), limit_seconds=240 * 60)


@query
def error_streaks(inputs):
    return monitor.error_streaks(inputs.fetches(), tolerated=2)


@query
def leader_changes(inputs):
    return metadata.leader_changes(metadata.parse_states(inputs.topic_state()))


@query
def commit_cadence(inputs):
    return monitor.commit_cadence(inputs.commits(), width="1 day")


# --- order and range checks


@query
def ordered_partitions(inputs):
    return metadata.ordered_partitions(_leaders(inputs))


@query
def out_of_range(inputs):
    bounds, saved = _bounds(inputs), inputs.checkpoints()
    both = offsets.out_of_range(bounds, saved, policy="earliest").unionByName(
        offsets.out_of_range(bounds, saved, policy="latest")
    )
    return both.select(*LOG_KEYS, "committed", "status", "reset_off", "policy")


@query
def offset_lag(inputs):
    lag = offsets.offset_lag(_bounds(inputs), inputs.checkpoints(), max_behind=300)
    return lag.select(*LOG_KEYS, "lag", "too_far")


@query
def inflight_offsets(inputs):
    return offsets.inflight_after(inputs.log(), stage(inputs.checkpoints(), "checkpoints"))


# --- the mirror


@query
def mirror_batch(inputs):
    rows = mirror.mirror_batch(
        inputs.stored_log(), inputs.checkpoints(), target="sync_", value="payload", key="sequence", as_text=True
    )
    return rows.select(
        *LOG_KEYS, "off", F.col("key").alias("new_key"), F.col("payload").alias("value"), "batch_id"
    )


# --- streams


for _build in streams.STREAMS.values():
    query(_build)
