"""Quality by ordinal regression with cumulative links on graded ratings.

The grades 0 < 1 < .. < K share one linear score of hashed text features. Ordered thresholds cut the
score: P(grade > k) = sigmoid(score - threshold[k]). The thresholds are kept apart by steps that are
exponentials, so they stay in order while weights and thresholds are trained together. The model gives
each text an expected grade and the tail probability of reaching a wanted grade, by which it is selected.

Training takes a bounded sample of rated rows (``PER_GRADE`` of each grade or so) to the driver;
prediction covers every row and whole text in one scan without a shuffle.

Results in special cases: null and empty texts have no features, get grade and tail 0 and are not
selected; a null rating is none; without ratings nothing is selected; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.features import (
    BUCKETS,
    SHAPES,
    Rows,
    features,
    labelled_sample,
    sigmoid,
    train,
    word_presence,
    word_shapes,
)

PER_GRADE = 2500
SELECT = 0.5


@dataclass(frozen=True)
class Ordinal:
    """One weight table for all grades, and the ordered thresholds between them."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, rows: Rows) -> np.ndarray:
        """P(grade > k) for each k."""
        return sigmoid(rows.dot(self.weights)[:, None] - self.thresholds[None, :])


def _thresholds(extra: np.ndarray) -> np.ndarray:
    return extra[0] + np.r_[0, np.cumsum(np.exp(extra[1:]))]


def fit_ordinal(rows: Rows, grades: np.ndarray, top: int) -> Ordinal:
    """Maximum likelihood of the grades 0 .. ``top``."""

    def slopes(margin, picked, extra):
        cut = _thresholds(extra)
        above = sigmoid(margin[:, None] - cut[None, :])
        every = np.hstack([np.ones((len(margin), 1)), above, np.zeros((len(margin), 1))])
        bend = every * (1 - every)
        g, at = grades[picked], np.arange(len(margin))
        p = np.maximum(every[at, g] - every[at, g + 1], 1e-9)
        at_margin = -(bend[at, g] - bend[at, g + 1]) / p
        at_cut = np.zeros((len(margin), top + 2))
        at_cut[at, g] += bend[at, g] / p
        at_cut[at, g + 1] -= bend[at, g + 1] / p
        at_cut = at_cut[:, 1:-1].sum(axis=0)
        # a threshold moves with the first one and with every step below it
        tail = np.cumsum(at_cut[::-1])[::-1]
        return at_margin, np.r_[tail[0], tail[1:] * np.exp(extra[1:])]

    weights, extra = train(rows, BUCKETS + SHAPES, slopes, np.zeros(top))
    return Ordinal(weights.astype(np.float32), _thresholds(extra))


def fit(docs: DataFrame, ratings: DataFrame, grade: Column, top: int, *, per_grade: int = PER_GRADE) -> Ordinal | None:
    """Train on a bounded sample of ``docs(doc_id, text)`` that have ``ratings(doc_id, ..)``.

    ``grade`` is an expression over the ratings, 0 .. ``top`` or null.
    """
    drawn = labelled_sample(docs, ratings, grade, dict.fromkeys(range(top + 1), per_grade), "quality")
    found = drawn.select("text", grade.cast("int").alias("grade")).collect()
    if not found:
        return None
    rows = features(pa.array([r["text"] for r in found], pa.string()), word_presence, word_shapes)
    return fit_ordinal(rows, np.array([r["grade"] for r in found], dtype=np.int64), top)


def score(docs: DataFrame, model: Ordinal | None, wanted: int) -> DataFrame:
    """``(doc_id, expected_grade, tail, selected)``; ``tail`` is the probability of grade ``wanted`` or more."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            rows = features(batch.column("text"), word_presence, word_shapes)
            some = np.diff(rows.bounds) > 0
            tails = model.tails(rows) * some[:, None] if model else np.zeros((len(rows), wanted))
            cols = [tails.sum(axis=1), np.ascontiguousarray(tails[:, wanted - 1]), tails[:, wanted - 1] >= SELECT]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c) for c in cols]], names=["doc_id", "expected_grade", "tail", "selected"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, expected_grade double, tail double, selected boolean"
    return docs.select("doc_id", "text").mapInArrow(predict, schema)
