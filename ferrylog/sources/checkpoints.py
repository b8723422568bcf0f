"""Saved offsets as a table of snapshots.

Each save writes the positions that moved, as a delta on the snapshot before it; a reader sees the old state or the
new one and never a mixture. Runs that may meet on the same partitions save with ``commit``, which compares with the
snapshot they began from.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylog.settings import LOG_KEYS
from ferrylog.sources.deltas import DeltaTable


class StaleWriter(RuntimeError):
    """Another run has saved positions since this one began."""


SCHEMA = "topic STRING, part INT, job_id STRING, committed BIGINT"


@dataclass(frozen=True)
class CheckpointStore:
    """Snapshots 0, 1, 2, ... of the saved offset of every partition."""

    root: str
    #: so many deltas are read on top of a base at most
    compact_every: int = 32

    @property
    def positions(self) -> DeltaTable:
        return DeltaTable(self.root, SCHEMA, LOG_KEYS, self.compact_every)

    def read(self, spark: SparkSession, snapshot: int) -> DataFrame:
        """One snapshot; the one before the first is empty."""
        return self.positions.read(spark, snapshot)

    def latest(self, spark: SparkSession) -> int:
        """Number of the newest complete snapshot, -1 when there is none."""
        return self.positions.latest(spark)

    def save(self, commits: DataFrame, snapshot: int, *, job_id: str) -> None:
        """Snapshot ``snapshot``: the one before it, with ``commits (topic, part, seq, off)`` on top.

        The last commit of a partition wins, whether or not it goes back. Saving a number again
        replaces that snapshot, as long as it has not been made a base.
        """
        new = commits.select(*LOG_KEYS, F.lit(job_id).alias("job_id"), F.col("off").alias("committed"), "seq")
        self.positions.write(new, snapshot, order="seq")

    def claim(self, spark: SparkSession, snapshot: int, owner: str) -> None:
        """Make a snapshot number one's own; ``StaleWriter`` if another run has it or a newer one is there.

        A claim is a file that is created if it is not there, which the file system does for one of several
        callers, with the owner's name in it. A run that was cut off claims its number again under the same name.
        To take over from an owner that is gone for good, claim the number after.
        """
        if self.latest(spark) > snapshot:
            raise StaleWriter(f"snapshot {snapshot} is outdated; the newest is {self.latest(spark)}")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_claims/{snapshot}")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        try:
            out = files.create(path, False)
        except Py4JJavaError:
            if not files.exists(path) or self._owner(spark, snapshot) != owner:
                raise StaleWriter(f"snapshot {snapshot} belongs to another run") from None
            return
        try:
            out.write(owner.encode())
        finally:
            out.close()

    def _owner(self, spark: SparkSession, snapshot: int) -> str:
        return "\n".join(r.value for r in spark.read.text(f"{self.root}/_claims/{snapshot}").collect())

    def commit(self, commits: DataFrame, expected: int, *, job_id: str, owner: str) -> int:
        """Save on top of snapshot ``expected``, the one that the run began from; return the new number.

        Of two runs that began from the same snapshot one saves, and the other fails without a change. Positions
        that the run did not move stay as they are.
        """
        spark = commits.sparkSession
        self.claim(spark, expected + 1, owner)
        self.save(commits, expected + 1, job_id=job_id)
        return expected + 1
