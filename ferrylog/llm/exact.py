"""Exact dedup by deterministic block naming.

A text without white space is cut into blocks of a fixed number of characters. The distinct blocks are
sorted and named by their place. Then neighbouring names are paired, the distinct pairs are sorted and
named in turn, and so on, until one name is left of each document. Equal names at the same level mean
equal texts: a name stands for one block, or for one pair of names, and for nothing else.

Blocks are sorted by a 64-bit hash first and by their content where the hash is the same, so only
distinct blocks are shuffled with their content, once, after map-side grouping. All other steps move
integers. No group of equal documents is gathered anywhere: counts and winners are partial
aggregates, and names are joined back with AQE's skew splitting.

Results in special cases: a null text counts as empty, and all empty texts are equal; rows that share a
doc_id and a text stand or fall together; of equal texts with equally many characters a null doc_id
stays only when there is no other; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrylog.llm.ranking import number_sorted
from ferrylog.staging import scratch, small, stage

SPACE = r"[\x20\x09-\x0D]+"
BLOCK_CHARS = 1024


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def cut(text: Column, chars: int) -> Column:
    """Blocks of ``chars`` characters, the last one shorter; one empty block for an empty text."""
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chars}}}"), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(blocks)


def _blocks(docs: DataFrame, chars: int, hasher: Callable[[Column], Column]) -> DataFrame:
    """A row per block; facts about the document are on its first one."""
    facts = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        "doc_id",
        F.char_length(F.coalesce(F.col("text"), F.lit(""))).alias("n_chars"),
        normalised(F.col("text")).alias("norm"),
    ).withColumns({"sha": F.sha2("norm", 256), "blocks": cut(F.col("norm"), chars)})
    first = lambda c: F.when(F.col("pos") == 0, F.col(c)).alias(c)
    return (
        facts.select("rid", "doc_id", "n_chars", "sha", F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "block"))
        .withColumn("h", hasher(F.col("block")))
        .select("rid", first("doc_id"), first("n_chars"), first("sha"), "n", "pos", "block", "h")
    )


def _clashes(docs: DataFrame, chars: int, hasher: Callable[[Column], Column]) -> DataFrame:
    """Distinct blocks that share their hash with another one, numbered within the hash from 1."""
    blocks = docs.select(F.explode(cut(normalised(F.col("text")), chars)).alias("block"))
    distinct = blocks.select(hasher(F.col("block")).alias("h"), "block").distinct()
    shared = stage(distinct.groupBy("h").count().where("count > 1").select("h"), "shared")
    if shared.isEmpty():
        return shared.select("h", F.lit("").alias("block"), F.lit(0).alias("k"))
    k = F.row_number().over(Window.partitionBy("h").orderBy("block"))
    return stage(distinct.join(shared, "h").withColumn("k", k), "clashes")


def _named(rows: DataFrame, key: list[str]) -> DataFrame:
    """Put ``name`` in the place of ``key``: the place of the key among the sorted distinct keys."""
    distinct = rows.select(*key).distinct()
    names = stage(number_sorted(distinct, [F.asc(c) for c in key], "name"), "names")
    return rows.join(names, key).drop(*key)


def identities(
    docs: DataFrame, *, chars: int = BLOCK_CHARS, hasher: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """A row per row of ``docs``: ``(doc_id, n_chars, sha, level, name)``.

    Two rows have the same ``(level, name)`` exactly when their texts are equal without white space.
    """
    clashes = _clashes(docs, chars, hasher)
    blocks = _blocks(docs, chars, hasher)
    if clashes.isEmpty():
        keyed = blocks.drop("block").withColumn("k", F.lit(0))
    else:
        keyed = blocks.join(clashes, ["h", "block"], "left").drop("block").fillna({"k": 0})
    parts = stage(keyed, "blocks")
    facts = parts.where("pos = 0").select("rid", "doc_id", "n_chars", "sha")
    longest = parts.agg(F.max("n")).first()[0] or 0

    row = stage(_named(parts.select("rid", "n", "pos", "h", "k"), ["h", "k"]), "level")
    done = row.where("n = 1").select("rid", F.lit(0).alias("level"), "name")
    level = 0
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        at = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
        pairs = (
            row.where("n > 1")
            .groupBy("rid", ((F.col("n") + 1) / 2).cast("int").alias("n"), (F.col("pos") / 2).cast("int").alias("pos"))
            .agg(at(0).alias("a"), F.coalesce(at(1), F.lit(0)).alias("b"))
        )
        row = stage(_named(stage(pairs, "pairs"), ["a", "b"]), "level")
        done = done.unionByName(row.where("n = 1").select("rid", F.lit(level).alias("level"), "name"))
    return facts.join(done, "rid").drop("rid")


def dedup(docs: DataFrame, *, chars: int = BLOCK_CHARS, hasher: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Which row stays of each set of equal texts: ``(doc_id, keep_id, group_size, kept, text_sha256, n_chars)``.

    The row with the most characters (code points of the original text) stays, then the one with the
    smallest doc_id.
    """
    named = stage(identities(docs, chars=chars, hasher=hasher), "identities")
    best = F.min(F.struct((-F.col("n_chars")).alias("c"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d")))
    # staged, so that the join has exchanges of its own, which AQE may split for a hot name
    groups = stage(named.groupBy("level", "name").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")), "groups")
    kept = F.col("doc_id").eqNullSafe(F.col("best.d")) & (F.col("n_chars") == -F.col("best.c"))
    return named.join(groups, ["level", "name"]).select(
        "doc_id", F.col("best.d").alias("keep_id"), "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"), "n_chars"
    )


def keep_distinct(docs: DataFrame, *, chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows that ``dedup`` drops, all columns.

    Rows are found again by doc_id, text and length, as a doc_id may have several texts.
    """
    with scratch(docs.sparkSession):
        dropped = dedup(docs, chars=chars).where("NOT kept")
        dropped = dropped.select(F.col("doc_id").alias("__d"), F.unhex("text_sha256").alias("__h"), F.col("n_chars").alias("__n"))
        dropped = stage(dropped.distinct(), "dropped", outlives=True)
    text = F.col("text")
    same = (
        F.col("doc_id").eqNullSafe(F.col("__d"))
        & (F.unhex(F.sha2(normalised(text), 256)) == F.col("__h"))
        & (F.char_length(F.coalesce(text, F.lit(""))) == F.col("__n"))
    )
    return docs.join(small(dropped), same, "left_anti")
