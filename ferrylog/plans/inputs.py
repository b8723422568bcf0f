"""The tables that the registered queries run on, derived from the driver's Parquet files.

``events`` becomes a message log with trimmed heads and gaps, ``documents`` a log of large
payloads; checkpoints, commits, failures, leaders and fetch results follow from the log. The log is
stored once per session and data folder in the shared folder, in the layout a mirror reads, since
its offsets are ranks over the whole table; later queries scan it with pruning and pushed filters.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylog.functions.text import size_of
from ferrylog.operators.offsets import offset_bounds, resolve_start
from ferrylog.operators.ordered import number_rows
from ferrylog.operators.segments import StoredLog
from ferrylog.sources import table
from ferrylog.settings import LOG_KEYS
from ferrylog.staging import exists, new_folder, stage, state_of

LOG_SCHEMA = "off BIGINT, event_id BIGINT, payload STRING, ts TIMESTAMP_NTZ, topic STRING, part INT, seg STRING"
SNAPSHOTS = 4

_logs: dict[tuple, str] = {}


class Inputs:
    """Frames of one data folder; each method builds its plan when it is called."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    @cached_property
    def _log(self) -> DataFrame:
        return table.read_log(self.spark, self.log_folder(), LOG_SCHEMA)

    @cached_property
    def _stored(self) -> DataFrame | StoredLog:
        return table.stored_log(self.spark, self.log_folder(), LOG_SCHEMA)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def derive_log(self) -> DataFrame:
        """Every event; offsets start at ``100 * part``, and one is missing after every six rows."""
        part = (F.col("user_id") % 4).cast("int").alias("part")
        events = self.table("events").select(
            F.col("event_type").alias("topic"), part, "event_id", F.col("props").alias("payload"), "ts"
        )
        ranked = number_rows(events, "rn", order="event_id")
        off = F.expr("rn - 1 + (rn - 1) div 6 + 100 * part")
        return ranked.select(off.alias("off"), "event_id", "payload", "ts", *LOG_KEYS)

    def log_folder(self) -> str:
        """Folder of the stored log; it is written again if it was cleared away or its source has changed."""
        source = state_of(self.spark, f"{self.folder}/events.parquet")
        key = (self.spark.sparkContext.applicationId, self.folder, source)
        if key not in _logs or not exists(self.spark, f"{_logs[key]}/_SUCCESS"):
            path = new_folder(self.spark, "log")
            table.write_log(self.derive_log(), path, segments=True, ts="ts", value="payload")
            _logs[key] = path
        return _logs[key]

    def log(self) -> DataFrame:
        return self._log

    def stored_log(self) -> DataFrame | StoredLog:
        """The log with its manifest, for queries that look for offsets before they read rows."""
        return self._stored

    def partitions(self) -> DataFrame:
        """Known partitions; no offsets are needed for that."""
        part = (F.col("user_id") % 4).cast("int").alias("part")
        return self.table("events").select(F.col("event_type").alias("topic"), part).distinct()

    def doclog(self) -> DataFrame:
        """Documents as messages; ``n_bytes`` is taken at the scan, so that texts need not be shuffled."""
        documents = self.table("documents").select(
            F.col("source").alias("topic"),
            (F.col("doc_id") % 4).cast("int").alias("part"),
            "doc_id",
            size_of(F.col("text")).alias("n_bytes"),
            F.col("text").alias("payload"),
        )
        ranked = number_rows(documents, "rn", order="doc_id")
        return ranked.select(*LOG_KEYS, (F.col("rn") - 1).alias("off"), "doc_id", "n_bytes", "payload")

    def checkpoints(self) -> DataFrame:
        """No record for part 0, a trimmed offset for 1, one in range for 2, past the end for (view, 3)."""
        low, high = F.col("earliest"), F.col("latest") - 1
        position = (
            F.when(F.col("part") == 1, low - 5)
            .when((F.col("part") == 3) & (F.col("topic") == "view"), high + 50)
            .otherwise(F.floor((low + high) / 2))
        )
        return (
            offset_bounds(self.stored_log())
            .where("part <> 0")
            .withColumn("committed", position.cast("bigint"))
            .select(*LOG_KEYS, F.when(F.col("topic") < "f", "job-a").otherwise("job-b").alias("job_id"), "committed")
        )

    def checkpoint_starts(self) -> DataFrame:
        """Where a run that goes on from the checkpoints begins."""
        return stage(resolve_start(offset_bounds(self.stored_log()), self.checkpoints()), "starts")

    def commits(self) -> DataFrame:
        """Every event saves a position; one in six of them goes back."""
        back = F.greatest(F.col("off") - 60, F.lit(0))
        off = F.when(F.col("event_id") % 6 == 1, back).otherwise(F.col("off") + 1)
        return self.log().select(*LOG_KEYS, F.col("event_id").alias("seq"), off.alias("off"), "ts")

    def failed(self) -> DataFrame:
        """The list of failed rows, reported as they were written."""
        return self.log().where("event_id % 97 = 1").select(*LOG_KEYS, "off", F.col("ts").alias("failed_at"))

    def finished(self) -> DataFrame:
        """What has finished out of order: one row in eight is still open wherever it lies."""
        return self.log().where("event_id % 8 <> 3").select(*LOG_KEYS, "off")

    def leader_reports(self) -> DataFrame:
        """Who leads a partition from a moment on, NULL when nobody does; the log's own rows tell, one in 53."""
        leader = F.when(F.col("event_id") % 7 != 0, F.col("event_id") % 4).cast("int")
        return self.log().where("event_id % 53 = 1").select(*LOG_KEYS, "ts", "event_id", leader.alias("leader"))

    def topic_state(self) -> DataFrame:
        """Leaders at four snapshots: ``click`` moves at the second, (view, 3) has none at the first."""
        snaps = F.explode(F.array(*[F.lit(n) for n in range(SNAPSHOTS)])).alias("snap")
        rows = self.partitions().select(snaps, *LOG_KEYS)
        here, after = (F.col("part") % 3).cast("string"), ((F.col("part") + 1) % 3).cast("string")
        leader = (
            F.when(F.expr("topic = 'view' AND part = 3 AND snap = 1"), "null")
            .when(F.expr("topic = 'click' AND snap >= 2"), after)
            .otherwise(here)
        )
        state = F.format_string(
            '{"controller_epoch":4,"isr":[%s,%s],"leader":%s,"leader_epoch":%s,"version":1}',
            here,
            after,
            leader,
            F.col("snap").cast("string"),
        )
        return rows.select("snap", *LOG_KEYS, state.alias("state"))

    def brokers(self) -> DataFrame:
        """One broker per supplier; the ids leave out 2, which leads partitions but is not listed."""
        key = F.col("s_suppkey")
        broker_id = F.when(key >= 2, key + 1).otherwise(key).cast("int")
        rows = self.table("supplier").select(broker_id.alias("broker_id")).select(
            "broker_id",
            F.format_string("node%d.example", "broker_id").alias("host"),
            (F.col("broker_id") % 2 + 9092).alias("port"),
        )
        info = F.format_string('{"host":"%s","jmx_port":9999,"port":%d,"version":1}', "host", "port")
        return rows.select("broker_id", info.alias("info"))

    def nodes(self) -> DataFrame:
        """Checkpoints, the last topic states and the brokers as an exported tree."""
        saved = self.checkpoints().select(
            F.format_string("/consumers/demo/offsets/%s/%d", "topic", "part").alias("path"),
            F.col("committed").cast("string").alias("data"),
        )
        states = (
            self.topic_state()
            .where("snap = 3")
            .select(F.format_string("/brokers/topics/%s/partitions/%d/state", "topic", "part").alias("path"), "state")
        )
        brokers = self.brokers().select(F.format_string("/brokers/ids/%d", "broker_id").alias("path"), "info")
        return saved.union(states).union(brokers)

    def fetches(self) -> DataFrame:
        """One fetch result per event; failing fetches cover the codes -1 to 14."""
        code = F.when(F.col("event_type") == "error", F.col("event_id") % 16 - 1).otherwise(0)
        return self.table("events").select(
            (F.col("user_id") % 4).cast("int").alias("part"),
            F.col("event_id").alias("seq"),
            code.cast("int").alias("error_code"),
        )

    def endpoint_lists(self) -> DataFrame:
        """A comma-separated list per event, with default ports, empty ports and unreadable items."""
        user, event = F.col("user_id"), F.col("event_id")
        host = F.format_string("host%d.example", user)
        item = (
            F.when(event % 5 == 0, host)
            .when(event % 5 == 1, F.concat(host, F.lit(":")))
            .when(event % 5 == 2, F.concat(host, F.lit(":"), (9000 + event % 100).cast("string")))
            .when(event % 5 == 3, F.concat(host, F.lit(":1:2")))
            .otherwise(F.concat(host, F.lit(":x")))
        )
        lists = F.concat(item, F.lit(","), F.format_string("spare%d.example:9093", event % 13))
        return self.table("events").select(lists.alias("endpoints"))
