"""Hashed features of whole texts, and linear models on them trained in numpy.

A row of features is sparse: buckets and values. ``word_presence`` marks the distinct words of a text,
``word_shapes`` gives the shares of its word shapes (kind of the first and the last two characters) and
of words that repeat the one before. Models are trained on the driver on bounded samples; tasks get
their weight tables, a few megabytes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.words import Words, mix, slices
from ferrylog.staging import stage

BUCKETS = 1 << 18
SHAPES = 1 << 12

_KIND = np.arange(256, dtype=np.uint64)
_KIND[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = ord("a")
_KIND[ord("0") : ord("9") + 1] = ord("0")


@dataclass
class Rows:
    """Sparse rows: the buckets and values of row i are at ``bounds[i]:bounds[i + 1]``."""

    bounds: np.ndarray
    buckets: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def dot(self, weights: np.ndarray) -> np.ndarray:
        """Sum of value times weight of each row."""
        out = np.zeros(len(self))
        some = np.flatnonzero(np.diff(self.bounds))
        if len(some):
            out[some] = np.add.reduceat(self.values * weights[self.buckets], self.bounds[some])
        return out

    def back(self, slopes: np.ndarray, size: int) -> np.ndarray:
        """Sum of value times slope of each bucket."""
        each = np.repeat(slopes, np.diff(self.bounds)) * self.values
        return np.bincount(self.buckets, weights=each, minlength=size)

    def take(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.bounds)[rows]
        bounds = np.r_[0, np.cumsum(sizes)]
        at = np.repeat(self.bounds[rows] - bounds[:-1], sizes) + np.arange(bounds[-1])
        return Rows(bounds, self.buckets[at], self.values[at])

    def beside(self, other: Rows) -> Rows:
        """Both features of each row."""
        row = np.r_[np.repeat(np.arange(len(self)), np.diff(self.bounds)), np.repeat(np.arange(len(other)), np.diff(other.bounds))]
        order = np.argsort(row, kind="stable")
        bounds = self.bounds + other.bounds
        return Rows(bounds, np.r_[self.buckets, other.buckets][order], np.r_[self.values, other.values][order])


def from_columns(columns: np.ndarray, first: int) -> Rows:
    """A dense column j as bucket ``first + j``."""
    n, k = columns.shape
    return Rows(np.arange(n + 1) * k, np.tile(np.arange(first, first + k), n), columns.reshape(-1).astype(np.float64))


def stacked(parts: list[Rows]) -> Rows:
    """Rows one after another."""
    sizes = np.concatenate([np.diff(p.bounds) for p in parts]) if parts else np.zeros(0, dtype=np.int64)
    join = lambda name, kind: np.concatenate([getattr(p, name) for p in parts]) if parts else np.zeros(0, kind)
    return Rows(np.r_[0, np.cumsum(sizes)].astype(np.int64), join("buckets", np.int64), join("values", np.float64))


def _summed(row: np.ndarray, bucket: np.ndarray, rows: int, size: int) -> tuple[Rows, np.ndarray]:
    """One entry per row and bucket; the counts come beside."""
    key, counts = np.unique(row * size + bucket, return_counts=True)
    bounds = np.searchsorted(key, np.arange(rows + 1) * size)
    return Rows(bounds, key % size, np.ones(len(key))), counts


def word_presence(words: Words) -> Rows:
    """1 in the bucket of each distinct word."""
    row = np.repeat(np.arange(len(words.counts)), words.counts)
    return _summed(row, (words.hashes % np.uint64(BUCKETS)).astype(np.int64), len(words.counts), BUCKETS)[0]


def word_shapes(words: Words, scale: float = 4.0) -> Rows:
    """``scale`` times the share of each shape, and of repeated words, in buckets of their own from ``BUCKETS`` on."""
    rows = len(words.counts)
    row = np.repeat(np.arange(rows), words.counts)
    first = _KIND[words.letters[words.at]]
    last = words.at + words.lengths - 1
    shape = (first << np.uint64(16)) | (_KIND[words.letters[np.maximum(last - 1, words.at)]] << np.uint64(8)) | _KIND[words.letters[last]]
    bucket = (mix(shape) % np.uint64(SHAPES - 1)).astype(np.int64)
    again = np.zeros(len(row), dtype=bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (row[1:] == row[:-1])
    row, bucket = np.r_[row, row[again]], np.r_[bucket, np.full(again.sum(), SHAPES - 1)]
    found, counts = _summed(row, bucket, rows, SHAPES)
    sizes = np.maximum(np.repeat(words.counts, np.diff(found.bounds)), 1)
    return Rows(found.bounds, found.buckets + BUCKETS, scale * counts / sizes)


def features(texts: pa.Array, *makers: Callable[[Words], Rows]) -> Rows:
    """Features of whole texts, a slice of a few megabytes at a time."""
    parts = []
    for _, _, raw, offsets in slices(texts):
        words = Words(raw, offsets)
        row = makers[0](words)
        for maker in makers[1:]:
            row = row.beside(maker(words))
        parts.append(row)
    return stacked(parts)


def labelled_sample(docs: DataFrame, labels: DataFrame, stratum: Column, wanted: dict[int, int], salt: str) -> DataFrame:
    """Documents with their labels, about ``wanted[s]`` of each stratum, chosen by a hash of doc_id.

    ``stratum`` is an expression over the labels; null ones are left out. The labels are drawn first,
    at most twice what is wanted, so their size is bounded and the texts are found by a broadcast
    join, without a shuffle of documents.
    """
    known = labels.withColumn("__stratum", stratum.cast("int")).where(F.col("__stratum").isin(*wanted))
    counts = dict(known.groupBy("__stratum").count().collect())
    space = 1 << 20
    share = F.lit(0)
    for kind, n in counts.items():
        share = F.when(F.col("__stratum") == kind, min(space, -(-wanted[kind] * space // n))).otherwise(share)
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(space)) < share).limit(2 * sum(wanted.values()))
    named = drawn.drop("text").withColumnRenamed("doc_id", "__id")
    own = [c for c in docs.columns if c in ("doc_id", "text") or c not in labels.columns]
    found = docs.select(*own).join(F.broadcast(stage(named, "drawn")), F.col("doc_id") == F.col("__id"))
    return found.where(F.col("text").isNotNull()).drop("__id")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(
    rows: Rows,
    size: int,
    slopes: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
    extra: np.ndarray,
    *,
    epochs: int = 16,
    batches: int = 10,
    rate: float = 0.3,
    lasso: float = 0.0003,
    seed: int = 5,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and extra parameters by stochastic gradients with Adagrad steps and an L1 pull to zero.

    ``slopes(margins, picked rows, extra)`` gives the loss's slope at each margin, and at each extra parameter.
    """
    weights, seen = np.zeros(size), np.full(size, 1e-6)
    extra, extra_seen = extra.astype(np.float64).copy(), np.full(len(extra), 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for picked in np.array_split(rng.permutation(len(rows)), batches):
            if not len(picked):
                continue
            some = rows.take(picked)
            at_margin, at_extra = slopes(some.dot(weights), picked, extra)
            slope = some.back(at_margin, size) / len(picked)
            seen += slope**2
            step = rate / np.sqrt(seen)
            weights -= step * slope
            weights = np.sign(weights) * np.maximum(np.abs(weights) - step * lasso, 0)
            at_extra = at_extra / len(picked)
            extra_seen += at_extra**2
            extra -= rate * at_extra / np.sqrt(extra_seen)
    return weights, extra
