"""Message-log mirroring and analytics as Spark jobs.

A log is a DataFrame with the columns ``topic string, part int, off bigint`` plus a payload;
``off`` is unique and ordered inside one (topic, part). Every operator is a plain function from
DataFrames to a DataFrame.
"""

from ferrylog.settings import MirrorSettings

__all__ = ["MirrorSettings"]
