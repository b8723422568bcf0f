"""Greedy cuts of a log: the next piece begins where the last one ended.

A fetch that is filled to its budget, and a position saved a minute after the last save, depend on all pieces before them. What
is handed on along a partition is one number only, the *mark* that a row must reach beyond to open the next piece. So

1. each segment of offsets is summarised as the step function from the mark that enters it to the mark that leaves it,
   within the marks that can come in at all;
2. functions of ``group`` neighbours are composed, level by level, until a partition has one group;
3. the marks that really enter are handed down the same levels, and each segment finds its own openings.

Every task sees one segment, or the functions of one group; no partition is walked through in one task. Functions are at most as
long as the rows that fit between two openings. Marks are whole numbers. A summary of one row per segment is windowed along each partition.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ferrylog.functions.text import size_of
from ferrylog.operators.ordered import SEGMENT_SPAN, accumulate, number_rows, segment_of
from ferrylog.settings import LOG_KEYS, MIB
from ferrylog.staging import stage

GROUP = 64

#: Before the first row: every row reaches beyond it.
_LOWEST = -(2**62)


def _leave(upto: np.ndarray, out: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Marks behind a stretch; a mark that no row reaches beyond goes through it."""
    piece = np.searchsorted(upto, marks, side="right")
    return np.where(piece < len(upto), np.append(out, 0)[piece], marks)


def _shorter(upto: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join neighbouring steps of one value."""
    ends = np.append(out[1:] != out[:-1], True) if len(out) else np.zeros(0, bool)
    return upto[ends], out[ends]


def _next_openings(begin: np.ndarray, reach: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Highest reach so far, and for a piece that begins at each row the row that opens the next one."""
    top = np.maximum.accumulate(reach)
    return top, np.maximum(np.searchsorted(top, begin + gap, side="right"), np.arange(1, len(begin) + 1))


def _function_of(rows: pd.DataFrame, order: str, gap: int) -> tuple[np.ndarray, np.ndarray]:
    rows = rows.sort_values(order)
    begin, reach = rows["__begin"].to_numpy(), rows["__reach"].to_numpy()
    top, after = _next_openings(begin, reach, gap)
    last = np.where(after < len(begin), after, np.arange(len(begin)))
    while True:  # pointer doubling to the last opening inside the segment
        further = last[last]
        if (further == last).all():
            break
        last = further
    records = np.flatnonzero(np.append(True, top[1:] > top[:-1]))
    upto, out = top[records], begin[last[records]] + gap
    # the greatest mark that can come in lies in the step that ends just above it
    needed = np.searchsorted(upto, rows["__most"].iloc[0], side="right") + 1
    return _shorter(upto[:needed], out[:needed])


def _compose(functions: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    functions = functions.sort_values("__seg")
    upto = np.unique(np.concatenate([*functions["upto"]]))
    marks = upto - 1  # one mark of each step
    for step, out in zip(functions["upto"], functions["out"], strict=True):
        marks = _leave(np.asarray(step), np.asarray(out), marks)
    return _shorter(upto, marks)


def _entering(functions: pd.DataFrame, mark: int) -> list[int]:
    """The mark in front of each stretch, in order of ``__seg``."""
    marks = []
    for step, out in zip(functions["upto"], functions["out"], strict=True):
        marks.append(mark)
        mark = int(_leave(np.asarray(step), np.asarray(out), np.array([mark]))[0])
    return marks


def openings(
    rows: DataFrame,
    *,
    begin: Column,
    reach: Column,
    gap: int,
    keys: Sequence[str] = LOG_KEYS,
    order: str = "off",
    span: int = SEGMENT_SPAN,
    group: int = GROUP,
) -> DataFrame:
    """``keys, order, begin`` of the rows that open a piece.

    The first row of a partition opens one. After a piece that opened at ``begin`` the next row whose ``reach`` is more than
    ``begin + gap`` opens another. Either ``reach`` never falls along a partition, as running totals do, or no row reaches
    beyond its own ``begin + gap``, as with times. ``order`` is unique in a partition. Rows without ``begin`` or ``reach`` are left out.
    """
    key_types = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    narrow = rows.select(*keys, order, begin.cast("bigint").alias("__begin"), reach.cast("bigint").alias("__reach"))
    narrow = narrow.where("__begin IS NOT NULL AND __reach IS NOT NULL").withColumn("__seg", segment_of(order, span))

    seen = Observation()
    peaks = narrow.groupBy(*keys, "__seg").agg(F.max("__begin").alias("__peak"))
    peaks = stage(peaks.observe(seen, F.min("__seg").alias("low"), F.max("__seg").alias("high")), "peaks")
    earlier = Window.partitionBy(*keys).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    most = F.coalesce(F.max("__peak").over(earlier) + gap, F.lit(_LOWEST))
    segments = stage(peaks.select(*keys, "__seg", most.alias("__most")), "marks")
    low, high = seen.get.get("low") or 0, seen.get.get("high") or 0

    columns = [*keys, "__seg", "upto", "out"]
    function_types = f"{key_types}, `__seg` BIGINT, upto ARRAY<BIGINT>, out ARRAY<BIGINT>"

    def summarise(key, part):
        return pd.DataFrame([[*key, *_function_of(part, order, gap)]], columns=columns)

    def compose(key, part):
        return pd.DataFrame([[*key, *_compose(part)]], columns=columns)

    def hand_down(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("__seg")
        mark = int(part["__mark"].iloc[0]) if "__mark" in part else _LOWEST
        return part[[*keys, "__seg"]].assign(__mark=_entering(part, mark))

    levels = [stage(narrow.join(segments, [*keys, "__seg"]).groupBy(*keys, "__seg").applyInPandas(summarise, function_types), "functions")]
    while high - low >= group:
        up = levels[-1].groupBy(*keys, F.expr(f"__seg div {int(group)}").alias("__up"))
        levels.append(stage(up.applyInPandas(compose, function_types), "functions"))
        low, high = int(low / group), int(high / group)  # towards zero, as ``div`` does

    mark_types = f"{key_types}, `__seg` BIGINT, `__mark` BIGINT"
    marks = stage(levels.pop().groupBy(*keys).applyInPandas(hand_down, mark_types), "marks")
    while levels:
        above = marks.withColumnRenamed("__seg", "__up")
        below = levels.pop().withColumn("__up", F.expr(f"__seg div {int(group)}")).join(above, [*keys, "__up"])
        marks = stage(below.groupBy(*keys, "__up").applyInPandas(hand_down, mark_types), "marks")

    def open_pieces(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(order)
        top, after = _next_openings(part["__begin"].to_numpy(), part["__reach"].to_numpy(), gap)
        at, found = int(np.searchsorted(top, part["__mark"].iloc[0], side="right")), []
        while at < len(part):
            found.append(at)
            at = int(after[at])
        return part.iloc[found][[*keys, order, "__begin"]].rename(columns={"__begin": "begin"})

    opened = narrow.join(marks, [*keys, "__seg"]).groupBy(*keys, "__seg")
    return opened.applyInPandas(open_pieces, f"{key_types}, `{order}` {rows.schema[order].dataType.simpleString()}, begin BIGINT")


def greedy_fetches(
    log: DataFrame, budget: int = MIB, *, size: Column | str | None = None, span: int = SEGMENT_SPAN, group: int = GROUP
) -> DataFrame:
    """Fetches filled one after the other: as many rows as fit into ``budget`` bytes, one at least.

    ``topic, part, fetch_id`` from 0, ``first_off``, ``next_off`` (where the next one begins; past the last row for the last) and
    ``bytes``. Payloads without size count as 0.
    """
    size = size_of(F.col("value")) if size is None else F.col(size) if isinstance(size, str) else size
    sized = log.select(*LOG_KEYS, "off", F.coalesce(size, F.lit(0)).cast("bigint").alias("__size"))
    totals = stage(accumulate(sized, sums={"__cum": F.col("__size")}, span=span), "totals")
    begin, reach = F.col("__cum") - F.col("__size"), F.col("__cum")
    opened = stage(openings(totals, begin=begin, reach=reach, gap=budget, span=span, group=group), "openings")
    numbered = number_rows(opened, "__number").withColumn("__down", -F.col("off"))
    nexts = {"next_off": F.col("off"), "__next": F.col("begin")}
    pieces = accumulate(stage(numbered, "pieces"), previous=nexts, order="__down")
    ends = totals.groupBy(*LOG_KEYS).agg((F.max("off") + 1).alias("__past"), F.max("__cum").alias("__all"))
    return pieces.join(stage(ends, "ends"), list(LOG_KEYS)).select(
        *LOG_KEYS,
        (F.col("__number") - 1).alias("fetch_id"),
        F.col("off").alias("first_off"),
        F.coalesce("next_off", "__past").alias("next_off"),
        (F.coalesce("__next", "__all") - F.col("begin")).alias("bytes"),
    )


def saves(commits: DataFrame, every: int, *, at: Column, order: str = "seq", span: int = SEGMENT_SPAN, group: int = GROUP) -> DataFrame:
    """The commits that are saved: a partition's first one, then the first that comes ``every`` or more after the last save.

    ``at`` is a whole number such as ``asof.micros`` of a time, and need not rise. Commits without a time are not saved.
    """
    chosen = openings(commits, begin=at, reach=at, gap=every - 1, order=order, span=span, group=group)
    return commits.join(stage(chosen.drop("begin"), "saves"), [*LOG_KEYS, order])
