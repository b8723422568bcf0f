"""Brokers, leaders, assignments and checkpoints kept in a coordination tree.

A tree is exported as a table ``(path string, data string)``; topic state and broker nodes hold
JSON, checkpoint nodes decimal text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrylog.functions import endpoints, paths
from ferrylog.operators.ordered import accumulate
from ferrylog.settings import LOG_KEYS
from ferrylog.sources.deltas import DeltaTable

_KEYS = list(LOG_KEYS)

STATE_SCHEMA = "controller_epoch INT, isr ARRAY<INT>, leader INT, leader_epoch INT, version INT"
BROKER_SCHEMA = "host STRING, jmx_port INT, port INT, version INT"
NODE_SCHEMA = "leader INT, isr ARRAY<INT>, host STRING, port INT"


def read_nodes(nodes: DataFrame) -> DataFrame:
    """Classify every node by its path and parse what it holds."""
    parsed = F.from_json("data", NODE_SCHEMA)
    return nodes.select(
        "path",
        paths.kind_of(F.col("path")).alias("kind"),
        paths.topic_of(F.col("path")).alias("topic"),
        paths.part_of(F.col("path")).alias("part"),
        paths.broker_id_of(F.col("path")).alias("broker_id"),
        F.col("data").try_cast("bigint").alias("committed"),
        parsed["leader"].alias("leader"),
        parsed["isr"].alias("isr"),
        parsed["host"].alias("host"),
        parsed["port"].alias("port"),
    )


def checkpoint_read(nodes: DataFrame) -> DataFrame:
    """Saved offset of each partition that has a checkpoint node; unreadable text gives NULL."""
    return read_nodes(nodes).where("kind = 'offset'").select(*LOG_KEYS, "committed")


def checkpoint_nodes(checkpoints: DataFrame) -> DataFrame:
    """Checkpoints as nodes, the inverse of ``checkpoint_read``."""
    return checkpoints.select(
        paths.offset_path(F.col("topic"), F.col("part")).alias("path"),
        F.col("committed").cast("string").alias("data"),
    )


def checkpoint_job_nodes(checkpoints: DataFrame) -> DataFrame:
    """Checkpoints as JSON nodes that name the job which saved them."""
    body = F.struct(F.struct(F.col("job_id").alias("id")).alias("topology"), F.col("committed").alias("offset"))
    return checkpoints.select(
        paths.offset_path(F.col("topic"), F.col("part")).alias("path"), F.to_json(body).alias("data")
    )


def checkpoint_job_read(nodes: DataFrame) -> DataFrame:
    """Job and offset of the JSON form; text that is no such JSON gives NULL for both."""
    parsed = F.from_json("data", "topology STRUCT<id: STRING>, offset BIGINT")
    return nodes.where(paths.kind_of(F.col("path")) == "offset").select(
        paths.topic_of(F.col("path")).alias("topic"),
        paths.part_of(F.col("path")).alias("part"),
        parsed["topology"]["id"].alias("job_id"),
        parsed["offset"].alias("committed"),
    )


def checkpoint_upsert(commits: DataFrame) -> DataFrame:
    """Last write wins per partition, even when it goes back."""
    return commits.groupBy(*LOG_KEYS).agg(F.max_by("off", "seq").alias("off"), F.max("seq").alias("seq"))


def node_json(nodes: DataFrame) -> DataFrame:
    """Leader of state nodes, address of broker nodes."""
    return read_nodes(nodes).select("path", "leader", "host", "port")


def broker_json(host: Column, port: Column) -> Column:
    """The body of a broker node."""
    return F.to_json(
        F.struct(host.alias("host"), F.lit(9999).alias("jmx_port"), port.alias("port"), F.lit(1).alias("version"))
    )


def state_json(leader: Column, isr: Column, *, epoch: Column | int = 0) -> Column:
    """The body of a topic state node; a partition without a leader has ``null``."""
    epoch = F.lit(epoch) if isinstance(epoch, int) else epoch
    body = F.struct(
        F.lit(1).alias("controller_epoch"),
        isr.alias("isr"),
        leader.alias("leader"),
        epoch.alias("leader_epoch"),
        F.lit(1).alias("version"),
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def node_paths(nodes: DataFrame, *, client: str = "sync") -> DataFrame:
    """Kind, topic and partition named by each path, with the client id a reader would use."""
    read = read_nodes(nodes)
    return read.select(
        "path",
        "kind",
        *LOG_KEYS,
        F.when(F.col("part").isNotNull(), paths.client_id(client, F.col("part"))).alias("client_id"),
    )


def endpoint_parse(lists: DataFrame, *, column: str = "endpoints") -> DataFrame:
    """Distinct endpoints of comma-separated lists; what cannot be read is marked, not dropped."""
    items = lists.select(F.explode(F.split(F.rtrim(F.col(column), F.lit(",")), ",")).alias("endpoint"))
    endpoint = F.col("endpoint")
    parsed = items.select(
        "endpoint",
        endpoints.host_of(endpoint).alias("host"),
        endpoints.port_of(endpoint).alias("port"),
        endpoints.is_valid(endpoint).alias("valid"),
    )
    text = endpoints.endpoint_text(F.col("host"), F.col("port"))
    return parsed.select(
        F.when(F.col("valid"), F.col("host")).alias("host"),
        F.when(F.col("valid"), F.col("port")).alias("port"),
        F.when(F.col("valid"), text).otherwise(endpoint).alias("endpoint"),
        "valid",
    ).distinct()


def parse_states(topic_state: DataFrame) -> DataFrame:
    """Leader and in-sync replicas of every partition and snapshot."""
    state = F.from_json("state", STATE_SCHEMA)
    return topic_state.select("snap", *LOG_KEYS, state["leader"].alias("leader"), state["isr"].alias("isr"))


def parse_brokers(brokers: DataFrame) -> DataFrame:
    info = F.from_json("info", BROKER_SCHEMA)
    return brokers.select("broker_id", info["host"].alias("host"), info["port"].alias("port"))


def partition_leaders(states: DataFrame, brokers: DataFrame) -> DataFrame:
    """Address of each partition's leader; partitions led by an unknown broker are left out."""
    return states.select(*LOG_KEYS, "leader").join(brokers, F.col("leader") == F.col("broker_id")).drop("broker_id")


def ordered_partitions(leaders: DataFrame) -> DataFrame:
    """Partitions in order, each with the rank of its broker by host, then port.

    The ranked list is the distinct brokers of a cluster, not its partitions or rows.
    """
    ranks = leaders.select("host", "port").distinct()
    ranks = ranks.withColumn("broker_rank", F.row_number().over(Window.orderBy("host", "port")))
    return leaders.join(ranks, ["host", "port"]).select(*LOG_KEYS, "host", "port", "broker_rank").orderBy(*LOG_KEYS)


def replica_hosts(states: DataFrame, brokers: DataFrame) -> DataFrame:
    """Hosts of the in-sync replicas, joined by commas in replica order; unknown brokers are left out."""
    replicas = states.select(*LOG_KEYS, F.posexplode("isr").alias("pos", "broker_id"))
    known = replicas.join(brokers, "broker_id").groupBy(*LOG_KEYS)
    hosts = known.agg(F.array_sort(F.collect_list(F.struct("pos", "host"))).alias("__hosts"))
    return hosts.select(*LOG_KEYS, F.array_join(F.col("__hosts.host"), ",").alias("hosts"))


def partition_count(states: DataFrame) -> DataFrame:
    return states.groupBy("topic").agg(F.count_distinct("part").alias("n_parts"))


def partitions_led_by(states: DataFrame, *, broker_id: int | None = None) -> DataFrame:
    """Partitions led by one broker, or by each of them."""
    led = states.where(F.col("leader").isNotNull() if broker_id is None else F.col("leader") == broker_id)
    led = led.select("leader", *LOG_KEYS).distinct().groupBy("leader", "topic")
    return led.agg(
        F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("part")), ",").alias("parts")
    )


def broker_id_for_host(brokers: DataFrame, prefix: str) -> DataFrame:
    """Highest id among the brokers whose host starts with a text; NULL when there is none."""
    return brokers.where(F.col("host").startswith(prefix)).agg(
        F.lit(prefix).alias("prefix"), F.max("broker_id").alias("broker_id")
    )


def assignments(states: DataFrame) -> DataFrame:
    """Which broker leads which partition; partitions without a leader are in no one's hands."""
    return states.where(F.col("leader").isNotNull()).select(F.col("leader").alias("broker_id"), *LOG_KEYS)


def assignment_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Partitions added to, removed from and kept by each broker between two assignments."""
    key = ["broker_id", *LOG_KEYS]
    both = old.withColumn("__old", F.lit(True)).join(new.withColumn("__new", F.lit(True)), key, "full")
    change = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").otherwise("kept")
    return both.select(*key, change.alias("change"))


def assignment_changed(diff: DataFrame) -> DataFrame:
    """Whether each broker has to restart its readers."""
    return diff.groupBy("broker_id").agg(F.bool_or(F.col("change") != "kept").alias("changed"))


def _leader_history(states: DataFrame) -> DataFrame:
    """Each snapshot of a partition with the leader of the snapshot before it."""
    return accumulate(
        states.select("snap", *LOG_KEYS, "leader"),
        order="snap",
        sums={"nth": F.lit(1).cast("bigint")},
        previous={"old_leader": F.col("leader")},
    )


def leader_changes(states: DataFrame) -> DataFrame:
    """Snapshots at which a partition's leader differs from the snapshot before.

    ``no_leader`` when it was lost, ``elected`` when there is one again, ``moved`` otherwise.
    """
    old, new = F.col("old_leader"), F.col("leader")
    kind = F.when(new.isNull(), "no_leader").when(old.isNull(), "elected").otherwise("moved")
    changed = _leader_history(states).where((F.col("nth") > 1) & ~old.eqNullSafe(new))
    return changed.select(*LOG_KEYS, "snap", "old_leader", new.alias("new_leader"), kind.alias("kind"))


def accept_leader(tries: DataFrame, *, keys: Sequence[str] = LOG_KEYS, max_tries: int = 3) -> DataFrame:
    """The leader a reader settles on after a failure, NULL when it gives up.

    ``tries`` has the old leader's host and what each look-up returned (``try_no`` from 0). A known
    leader is taken, but the old one, whatever the case of its name, only from the second try on.
    """
    same = F.lower("old_host") == F.lower("host")
    fits = F.col("host").isNotNull() & ((F.col("try_no") > 0) | ~F.coalesce(same, F.lit(False)))
    usable = fits & (F.col("try_no") < max_tries)
    return tries.groupBy(*keys).agg(F.min_by(F.when(usable, F.col("host")), F.when(usable, F.col("try_no"))).alias("host"))


def registrations(states: DataFrame) -> DataFrame:
    """Register and unregister events that the snapshots imply, in the order of ``seq``."""
    old, new = F.col("old_leader"), F.col("leader")
    gone = F.struct(old.alias("broker_id"), (F.col("snap") * 2).alias("seq"), F.lit("unregister").alias("action"))
    come = F.struct(new.alias("broker_id"), (F.col("snap") * 2 + 1).alias("seq"), F.lit("register").alias("action"))
    moved = _leader_history(states).where((F.col("nth") == 1) | ~old.eqNullSafe(new))
    events = moved.select(*LOG_KEYS, F.inline(F.array(gone, come)))
    return events.where("broker_id IS NOT NULL").select("broker_id", *LOG_KEYS, "seq", "action")


def broker_partitions(events: DataFrame) -> DataFrame:
    """Partitions registered with each broker after all events; a broker without any is not listed."""
    last = events.groupBy("broker_id", *LOG_KEYS).agg(F.max_by("action", "seq").alias("action"))
    return held_partitions(last.where("action = 'register'"))


def held_partitions(registered: DataFrame) -> DataFrame:
    """Partitions of each broker and topic, as one text."""
    held = registered.groupBy("broker_id", "topic")
    return held.agg(F.array_join(F.array_sort(F.collect_list("part")), ",").alias("parts"))


def registry(root: str, *, compact_every: int = 32) -> DeltaTable:
    """Which partitions are registered with which brokers, as a table that grows by what changed."""
    return DeltaTable(root, "broker_id INT, topic STRING, part INT, seq BIGINT", ("broker_id", *LOG_KEYS), compact_every)


def register(registry: DeltaTable, events: DataFrame, number: int) -> None:
    """Add events (``registrations``) to the registry as delta ``number``; the last one of a key counts."""
    registry.write(events, number, order="seq", gone=F.col("action") == "unregister")
