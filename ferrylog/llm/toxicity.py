"""Toxicity by a chain of classifiers.

The categories are predicted one after another by linear models on the distinct words of a text. Each
later model also gets the probabilities of the categories before it. It is trained with out-of-fold
predictions: the training rows are cut into folds, and a row's earlier probabilities come from models
that have not seen the row, so a later model does not learn to trust them more than it should. For new
texts the probabilities come from models trained on all rows.

Training takes a bounded sample of labelled rows (``TRAIN_ROWS``, a third of them positive where there are
enough) to the driver. Prediction covers every row and whole text, in one scan without a shuffle.

Results in special cases: null and empty texts have no words and get the probabilities of the biases,
but are never flagged; without labelled rows all probabilities are 0; a null label is no label; rows
that repeat a doc_id each get a result; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.features import BUCKETS, Rows, features, from_columns, labelled_sample, sigmoid, train, word_presence

TRAIN_ROWS = 6000
FOLDS = 3
FLAG = 0.5


def _odds(probabilities: np.ndarray) -> np.ndarray:
    p = np.clip(probabilities, 0.01, 0.99)
    return np.log(p / (1 - p)) / 4


@dataclass(frozen=True)
class Chain:
    """Weights and bias of each category; those of earlier categories stand after the words'."""

    names: list[str]
    weights: list[np.ndarray]
    biases: list[float]

    def probabilities(self, rows: Rows) -> np.ndarray:
        found = np.zeros((len(rows), len(self.names)))
        for k in range(len(self.names)):
            margin = rows.dot(self.weights[k][:BUCKETS]) + _odds(found[:, :k]) @ self.weights[k][BUCKETS:] + self.biases[k]
            found[:, k] = sigmoid(margin)
        return found


def _fit_one(rows: Rows, truth: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, float]:
    both = rows.beside(from_columns(_odds(earlier), BUCKETS)) if earlier.shape[1] else rows

    def slopes(margin, picked, extra):
        slope = sigmoid(margin + extra[0]) - truth[picked]
        return slope, np.array([slope.sum()])

    weights, extra = train(both, BUCKETS + earlier.shape[1], slopes, np.zeros(1))
    return weights.astype(np.float32), float(extra[0])


def fit_chain(rows: Rows, labels: np.ndarray, names: Sequence[str], *, folds: int = FOLDS) -> Chain:
    """``labels`` has a column of 0 and 1 for each name, in the order of the chain."""
    fold = np.random.default_rng(9).permutation(len(rows)) % folds
    chain = Chain(list(names), [], [])
    outside = np.zeros((len(rows), len(names)))
    for k in range(len(names)):
        truth = labels[:, k].astype(np.float64)
        weights, bias = _fit_one(rows, truth, outside[:, :k])
        chain.weights.append(weights)
        chain.biases.append(bias)
        if k + 1 == len(names):
            break
        for f in range(folds):
            rest, here = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if not len(rest) or not len(here):
                continue
            w, b = _fit_one(rows.take(rest), truth[rest], outside[rest, :k])
            margin = rows.take(here).dot(w[:BUCKETS]) + _odds(outside[here, :k]) @ w[BUCKETS:] + b
            outside[here, k] = sigmoid(margin)
    return chain


def fit(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column], *, rows: int = TRAIN_ROWS, drawn_by: str | None = None
) -> Chain | None:
    """Train on a bounded sample of ``docs(doc_id, text, ..)`` that have ``labels(doc_id, ..)``.

    A category is a boolean column of both, and their order is that of the chain. The one by which positives
    and negatives are drawn, the first one unless named, is a column of the labels alone.
    """
    parts = {1: rows // 3, 0: rows - rows // 3}
    drawn = labelled_sample(docs, labels, categories[drawn_by or next(iter(categories))], parts, "toxicity")
    truth = [F.coalesce(c, F.lit(False)).cast("int").alias(f"c{i}") for i, c in enumerate(categories.values())]
    found = drawn.select("text", *truth).collect()
    if not found:
        return None
    texts = pa.array([r["text"] for r in found], pa.string())
    return fit_chain(features(texts, word_presence), np.array([tuple(r)[1:] for r in found], dtype=np.int64), list(categories))


def score(docs: DataFrame, chain: Chain | None, names: Sequence[str], *, flag: str | None = None) -> DataFrame:
    """``(doc_id, p_<name>.., toxic)``: the probability of each category, and whether ``flag``, or the first one, is flagged."""
    judged = list(names).index(flag) if flag else 0
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    columns = ["doc_id", *[f"p_{n}" for n in names], "toxic"]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = sent.value
        for batch in batches:
            rows = features(batch.column("text"), word_presence)
            found = chain.probabilities(rows) if chain else np.zeros((len(rows), len(names)))
            flagged = (found[:, judged] >= FLAG) & (np.diff(rows.bounds) > 0)
            cols = [pa.array(np.ascontiguousarray(found[:, k])) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols, pa.array(flagged)], names=columns)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *[f"`p_{n}` double" for n in names], "toxic boolean"])
    return docs.select("doc_id", "text").mapInArrow(predict, schema)
