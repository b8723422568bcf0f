"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source_size`` times in the mix. Along the documents
of a source, in order of size and id, the expected copies are summed, one offset is added, and a
document is emitted once per whole number that its own share of the sum crosses. All shares of a
source are equal, so the sum before a document is its rank times the share: no rounding adds up and
reruns agree. The order by size spreads the copies over small and large documents alike, which keeps
the words taken within about one large document of the target.

Results in special cases: a null text has size 0; a null source is a source of its own, the last one;
a source without words has target 0 and takes nothing; an empty table gives no row; rows that repeat
a doc_id are documents of their own. Other columns, whatever their names, are not read by ``shares``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrylog.llm.ranking import number_sorted
from ferrylog.staging import scratch, small, stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = 20
#: Size up to which the list of copies is broadcast: a row of it takes about ten times as much in memory as in its file.
COPIES_BYTES = 8 << 20


def size_of_text(text: Column) -> Column:
    """Number of words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MAX_COPIES, seed: int = SEED) -> DataFrame:
    """Target words and sampling offset of each source: ``(source, source_size, target, offset)``.

    ``sizes`` has one row per source: ``(source, source_size)``. The weights repeat over the sources in
    code point order. A target stops at ``most`` times the source's size and the rest goes to the other
    sources by weight. As a source whose ``most * size / weight`` is lower stops earlier, the stopped
    ones are the first in that order: the level is found with one running sum.
    """
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    weighed = sizes.select(
        "source",
        "source_size",
        F.element_at(cycle, (place % len(weights) + 1).cast("int")).cast("bigint").alias("w"),
        (F.col("source_size") * most).alias("cap"),
        (((place * 2654435761 + seed) % 4294967296 % 1024 + 0.5) / 1024).alias("offset"),
    )
    every = Window.partitionBy()
    stops = Window.orderBy(F.col("cap") / F.col("w"), F.asc_nulls_last("source"))
    before = stops.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))
    )
    # the first source that need not stop fixes the level for itself and all after it
    levels = weighed.withColumn("level", level).withColumn("open", F.col("cap") >= F.col("w") * F.col("level"))
    fixed = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        stops.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    target = F.coalesce(F.least(F.col("w") * fixed, F.col("cap").cast("double")), F.col("cap").cast("double"))
    return levels.select("source", "source_size", target.alias("target"), "offset")


def shares(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MAX_COPIES, seed: int = SEED
) -> DataFrame:
    """How often each document is in the mix: ``(doc_id, source, size, source_size, target, copies)``, a row per row."""
    sized = docs.select("doc_id", "source", size_of_text(F.col("text")).alias("size"))
    order = [F.asc_nulls_last("source"), F.asc("size"), F.asc_nulls_last("doc_id")]
    ranked = stage(number_sorted(sized, order, "place"), "places")
    sizes = ranked.groupBy("source").agg(
        F.sum("size").alias("source_size"), (F.min("place") - 1).alias("first_place"), F.count(F.lit(1)).alias("n")
    )
    sizes = stage(sizes, "sources")
    goals = targets(sizes, weights, most, seed)
    facts = sizes.drop("source_size").join(
        goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))
    ).drop("s")
    facts = stage(facts.withColumnRenamed("source", "s"), "goals")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank = F.col("place") - F.col("first_place")
    upto = lambda n: F.floor(n * F.col("share") + F.col("offset"))
    return (
        ranked.join(facts, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("share", share)
        .select(
            "doc_id", "source", "size", "source_size", "target",
            F.least(upto(rank) - upto(rank - 1), F.lit(most)).alias("copies"),
        )
    )


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MAX_COPIES, seed: int = SEED) -> DataFrame:
    """The mix itself: every row of ``docs``, all columns, as often as ``shares`` says.

    The copies are joined to the texts by (doc_id, source, size). Rows that agree in all three cannot
    be told apart there; they divide the copies of the group evenly, the first ones taking the rest.
    """
    keys = ["__doc", "__source", "__size"]
    with scratch(docs.sparkSession):
        groups = (
            shares(docs, weights, most, seed)
            .groupBy(F.col("doc_id").alias("__d"), F.col("source").alias("__s"), F.col("size").alias("__z"))
            .agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows"))
            .where("__copies > 0")
        )
        groups = stage(groups, "copies", outlives=True)
    keyed = docs.withColumns({"__doc": F.col("doc_id"), "__source": F.col("source"), "__size": size_of_text(F.col("text"))})
    same = (
        F.col("__doc").eqNullSafe(F.col("__d"))
        & F.col("__source").eqNullSafe(F.col("__s"))
        & (F.col("__size") == F.col("__z"))
    )
    # a short list goes to the texts, so that they need not be shuffled to meet it
    joined = keyed.join(small(groups, COPIES_BYTES), same)
    alone = joined.where("__rows = 1")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("__doc"))
    even = F.floor(F.col("__copies") / F.col("__rows")) + (nth <= F.col("__copies") % F.col("__rows")).cast("bigint")
    several = joined.where("__rows > 1").withColumn("__copies", even).where("__copies > 0")
    return (
        alone.unionByName(several)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
