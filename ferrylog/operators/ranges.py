"""Sets of offsets as ranges.

A set is a frame ``topic, part, low, high`` with both ends included. Rows finish out of order, yet what is finished is mostly
long runs, so ranges stay few where a list of offsets grows with the log.

* Single offsets are turned into words of 64 bits by a partial aggregation before anything is shuffled.
* Sets are combined by a sweep: every range is a step up and a step down, steps at one offset are added up, and running totals
  tell what is covered. The totals go along segments (``ordered.accumulate``), so no partition is swept in one task.
* Results are sorted out: disjoint, not empty, and as long as can be. Inputs need not be.

Ranges with a missing end or with ``high < low`` hold nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.operators.asof import in_spans
from ferrylog.operators.ordered import accumulate
from ferrylog.settings import LOG_KEYS
from ferrylog.staging import stage

_KEYS = list(LOG_KEYS)

#: Ranges are cut at multiples of this when rows look for them.
LOOK_UP_SPAN = 1 << 10


def _edges_of_words(words: DataFrame) -> DataFrame:
    """First and last offset of each run of bits; a run that goes on in the next word is two ranges that touch."""
    places = "filter(sequence(0, 63), i -> (shiftrightunsigned({bits}, i) & 1) = 1)"
    lows = places.format(bits="bits & ~shiftleft(bits, 1)")
    highs = places.format(bits="bits & ~shiftrightunsigned(bits, 1)")
    pairs = words.select(*_KEYS, "word", F.inline(F.arrays_zip(F.expr(lows).alias("a"), F.expr(highs).alias("b"))))
    return pairs.select(*_KEYS, F.expr("word * 64 + a").alias("low"), F.expr("word * 64 + b").alias("high"))


def words_of(offsets: DataFrame) -> DataFrame:
    """Offsets by 64, a bit for each."""
    words = offsets.where("off IS NOT NULL").groupBy(*LOG_KEYS, F.shiftright("off", 6).alias("word"))
    return words.agg(F.expr("bit_or(shiftleft(1L, CAST(off & 63 AS INT)))").alias("bits"))


def of_offsets(offsets: DataFrame) -> DataFrame:
    """The ranges of single offsets ``topic, part, off``; repeated ones count once, missing ones not at all."""
    return normalised(_edges_of_words(words_of(offsets)))


def _combined(sets: Mapping[str, DataFrame], inside: Callable[[Mapping[str, Column]], Column]) -> DataFrame:
    steps = None
    for name, ranges in sets.items():
        ends = F.expr("inline(array(struct(low AS pos, 1 AS step), struct(high + 1 AS pos, -1 AS step)))")
        own = ranges.where("low <= high").select(*_KEYS, ends)
        own = own.select(*_KEYS, "pos", *[(F.col("step") if n == name else F.lit(0)).cast("bigint").alias(f"by_{n}") for n in sets])
        steps = own if steps is None else steps.unionByName(own)
    changed = F.lit(False)
    for name in sets:
        changed |= F.col(f"by_{name}") != 0
    steps = steps.groupBy(*LOG_KEYS, "pos").agg(*[F.sum(f"by_{n}").alias(f"by_{n}") for n in sets]).where(changed)
    swept = accumulate(stage(steps, "steps"), sums={f"to_{n}": F.col(f"by_{n}") for n in sets}, order="pos")
    after = inside({n: F.col(f"to_{n}") > 0 for n in sets})
    before = inside({n: F.col(f"to_{n}") > F.col(f"by_{n}") for n in sets})
    ends = stage(swept.where(after != before).select(*_KEYS, "pos", after.alias("opens")), "ends")
    paired = accumulate(ends, previous={"low": F.col("pos")}, order="pos")
    return paired.where(~F.col("opens")).select(*_KEYS, "low", (F.col("pos") - 1).alias("high"))


def normalised(ranges: DataFrame) -> DataFrame:
    """The same set, disjoint and with touching ranges joined."""
    return _combined({"a": ranges}, lambda of: of["a"])


def union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Offsets in either set."""
    return _combined({"a": left, "b": right}, lambda of: of["a"] | of["b"])


def intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Offsets in both sets."""
    return _combined({"a": left, "b": right}, lambda of: of["a"] & of["b"])


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Offsets in the left set alone."""
    return _combined({"a": left, "b": right}, lambda of: of["a"] & ~of["b"])


def below(positions: DataFrame, low: str = "earliest", position: str = "committed") -> DataFrame:
    """What lies before a position, one range per partition; nothing where the position is missing."""
    return positions.select(*_KEYS, F.col(low).alias("low"), (F.col(position) - 1).alias("high")).where("low <= high")


def contained(rows: DataFrame, ranges: DataFrame, name: str = "inside") -> DataFrame:
    """Rows with whether their offset lies in the set, which must be normalised."""
    spans = ranges.select(*_KEYS, "low", (F.col("high") + 1).alias("end"), F.lit(True).alias(name))
    met = in_spans(rows, spans, [name], at="off", since="low", until="end", width=LOOK_UP_SPAN)
    return met.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def inflight(emitted: DataFrame, finished: DataFrame) -> DataFrame:
    """Offsets emitted and not finished, in how many ranges, and the position that is safe to save.

    The position is the lowest open offset, or the one after the last that was emitted. What was finished without
    having been emitted does not count.
    """
    emitted = stage(emitted, "emitted")
    left = difference(emitted, finished).groupBy(*LOG_KEYS).agg(
        F.sum(F.col("high") - F.col("low") + 1).alias("n"), F.count("*").alias("parts"), F.min("low").alias("lowest")
    )
    ends = emitted.groupBy(*LOG_KEYS).agg((F.max("high") + 1).alias("end")).join(left, _KEYS, "left")
    return ends.select(
        *_KEYS,
        F.coalesce("n", F.lit(0)).alias("n_inflight"),
        F.coalesce("parts", F.lit(0)).alias("n_ranges"),
        F.coalesce("lowest", "end").alias("safe_off"),
    )
