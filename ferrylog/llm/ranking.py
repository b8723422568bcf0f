"""Row numbers over a whole table without sorting it in one task.

The rows are dealt by ranges of the sort key, so that many rows of one source, size or value still go
to many partitions as long as the whole key differs. Each partition numbers its own rows, and the
sizes of the partitions before it are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrylog.staging import stage


def number_sorted(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``, the place (from 1, bigint) of each row when all are sorted by ``order``.

    The dealt rows are staged, so both passes see the same ranges, also after an executor is lost.
    Rows that tie in ``order`` get neighbouring places in any order. The table of partition sizes has
    one row per partition. An empty table stays empty.
    """
    ranged = stage(df.repartitionByRange(*order).withColumn("__pid", F.spark_partition_id()), "ranged")
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    bases = stage(sizes.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base")), "bases")
    inside = F.row_number().over(Window.partitionBy("__pid").orderBy(*order))
    return (
        ranged.withColumn("__rn", inside)
        .join(bases, "__pid")
        .withColumn(name, F.col("__base") + F.col("__rn"))
        .drop("__pid", "__rn", "__base")
    )
