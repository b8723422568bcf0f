"""Small results written once to the cluster's shared folder.

Facts about partitions (bounds, start offsets, leaders) are joined to every row of a log. They are
written as a table first, for two reasons: they are computed once however often a plan uses them,
and the file size is known when the main plan is made. Spark then broadcasts them when they are
below ``spark.sql.autoBroadcastJoinThreshold``, and takes a sort-merge join with AQE's skew
splitting when they are not, so no unchecked broadcast is ever forced and the log itself is not
shuffled to meet a small table.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size up to which a staged list is broadcast by ``small``; a cluster with little memory lowers it.
LIST_BYTES = 64 << 20

_local_roots: dict[str, str] = {}
# open scopes of this thread: micro-batches run in threads of their own, beside other queries
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, a temporary one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="ferrylog-")
    return _local_roots[app]


def app_folder(spark: SparkSession) -> str:
    """Where this application stages; nothing else is kept there."""
    return f"{shared_root(spark)}/ferrylog-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's folder; nothing is created yet."""
    return f"{app_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> bool:
    """Delete what this application has staged, once none of its results is needed any more."""
    return delete(spark, app_folder(spark))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file is there, on whatever file system the path names."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none when it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def state_of(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Names, sizes and times of the files of a table; it differs once the table was written again."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = file.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in files.listStatus(file)))


def stage(df: DataFrame, label: str, *, outlives: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and return the table that reads it back.

    Inside ``scratch`` it is deleted at the end, or, with ``outlives``, with the scope around that one.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    scopes = _scopes.get()[:-1] if outlives else _scopes.get()
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder that is no longer needed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def small(staged: DataFrame, limit: int = LIST_BYTES) -> DataFrame:
    """A staged table marked for broadcast if its files are within ``limit``, and as it is beyond.

    For short lists that long rows are filtered by: the rows stay where they are, whatever the threshold of
    automatic broadcasts, and a list that has grown too long is met by a shuffle.
    """
    return F.broadcast(staged) if staged_bytes(staged) <= limit else staged


def staged_bytes(df: DataFrame) -> int:
    """Size of the files behind a staged table, as the optimizer sees it."""
    return int(df._jdf.queryExecution().analyzed().stats().sizeInBytes())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What this thread stages inside is deleted at the end; for work whose results are written inside too, such as a micro-batch."""
    mine: list[str] = []
    before = _scopes.set((*_scopes.get(), mine))
    try:
        yield
    finally:
        _scopes.reset(before)
        for path in mine:
            delete(spark, path)
