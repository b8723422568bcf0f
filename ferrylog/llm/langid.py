"""Language identification by averaged hashed subword embeddings.

A text's vector is the mean of the embeddings of its subwords: the 3- and 4-byte pieces inside words,
with the white space around them, hashed into a fixed table. A linear softmax on the mean gives the
languages. Embeddings and softmax are trained together by stochastic gradient descent in numpy on the
driver, on a bounded sample of labelled rows: ``PER_LANG`` rows or so of each language, fewer of each where
there are so many languages that ``SAMPLE_ROWS`` would be passed. Pieces that the sample does not have keep a zero embedding and vote for nobody.

Rejection is calibrated on rows of the sample that the training does not see: a temperature is fitted
to their likelihood, and the threshold is the score that all but ``REJECT`` of them reach. The share of
a text's pieces that the sample has is calibrated in the same way, with half of what those rows reach.
Texts in a language that was not learned have few known pieces and even scores, and fall below.

To predict, the embedding and the softmax are multiplied out to one table of scores per piece, a few
megabytes, which goes to the tasks; each text is read once, whole.

Results in special cases: a null text and one without a letter are ``und`` with score 0 and rejected;
without any labelled row every text is; a null doc_id is not held out; an empty table gives no row.
Only text and label are read for training, only text for prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.words import slices
from ferrylog.session import bounded_batches

BUCKETS = 1 << 18
DIM = 16
PER_LANG = 1000
SAMPLE_ROWS = 200_000
EPOCHS = 4
RATE = 0.5
REJECT = 0.001
HIGHEST_THRESHOLD = 0.4
UNKNOWN = "und"

_TEXT = np.arange(256, dtype=np.uint32)
_TEXT[ord("A") : ord("Z") + 1] += 32
_TEXT[[0x20, *range(0x09, 0x0E)]] = 0x20


def pieces(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each subword piece of a slice, in row order, and where the pieces of each row begin."""
    rows = len(offsets) - 1
    padded = np.full(len(raw) + rows + 5, 0x20, dtype=np.uint32)
    shift = np.repeat(np.arange(1, rows + 1), np.diff(offsets))
    padded[np.arange(len(raw)) + shift] = _TEXT[raw]
    solid = padded != 0x20
    count = len(raw) + rows + 1
    three = (padded[:count] << 16) | (padded[1 : count + 1] << 8) | padded[2 : count + 2]
    four = (three << 8) | padded[3 : count + 3]
    bucket = np.empty((count, 2), dtype=np.uint32)
    bucket[:, 0] = (three * np.uint32(2654435761)) >> 14
    bucket[:, 1] = ((four ^ np.uint32(0x5BD1E995)) * np.uint32(2246822519)) >> 14
    used = np.empty((count, 2), dtype=bool)
    used[:, 0] = solid[1 : count + 1]
    used[:, 1] = solid[1 : count + 1] & solid[2 : count + 2]
    before = np.r_[0, np.cumsum(used.sum(axis=1))]
    return bucket[used], before[offsets + np.arange(rows + 1)]


@dataclass(frozen=True)
class Model:
    """Scores of every piece for every language and whether it is known; how scores become probabilities."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    floor: float

    def probabilities(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A row of probabilities for each text, and the share of known pieces; without pieces those of the bias, and 0."""
        out = []
        for _, _, raw, offsets in slices(texts):
            found, bounds = pieces(raw, offsets)
            out.append(row_sums(self.table, found, bounds) / np.maximum(np.diff(bounds), 1)[:, None])
        found = np.concatenate(out) if out else np.zeros((0, len(self.langs) + 1))
        return softmax((found[:, :-1] + self.bias) / self.temperature), found[:, -1]

    def accepts(self, probabilities: np.ndarray, known: np.ndarray) -> np.ndarray:
        return (probabilities.max(axis=1) >= self.threshold) & (known >= self.floor)


def row_sums(table: np.ndarray, found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of table rows ``found[bounds[i]:bounds[i + 1]]``."""
    sums = np.zeros((len(bounds) - 1, table.shape[1]))
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        for c in range(table.shape[1]):
            sums[some, c] = np.add.reduceat(table[:, c][found], bounds[some], dtype=np.float64)
    return sums


def softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], *, seed: int = 3) -> Model | None:
    """Fit embeddings, softmax, temperature and threshold; one text in five is kept for calibration."""
    langs = sorted(set(labels))
    if not langs:
        return None
    truth = np.array([langs.index(x) for x in labels])
    bags = []
    for _, _, raw, offsets in slices(pa.array(texts, pa.string())):
        found, bounds = pieces(raw, offsets)
        bags += [np.unique(found[a:b], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    held, fit = (order[: len(order) // 5], order[len(order) // 5 :]) if len(order) >= 50 else (order, order)
    seen = np.zeros(BUCKETS, dtype=bool)
    for i in fit:
        seen[bags[i][0]] = True
    embed = rng.normal(0, 0.1, (BUCKETS, DIM)) * seen[:, None]
    weights, bias = rng.normal(0, 0.1, (DIM, len(langs))), np.zeros(len(langs))
    steps = EPOCHS * len(fit)
    for step in range(steps):
        if step % len(fit) == 0:
            rng.shuffle(fit)
        i = fit[step % len(fit)]
        at, n = bags[i]
        if not len(at):
            continue
        rate = RATE * (1 - step / steps)
        share = (n / n.sum())[:, None]
        mean = (embed[at] * share).sum(axis=0)
        slope = softmax((mean @ weights + bias)[None])[0]
        slope[truth[i]] -= 1
        back = weights @ slope
        weights -= rate * np.outer(mean, slope)
        bias -= rate * slope
        # the mean spreads a step over the pieces, so embeddings take a longer one
        embed[at] -= rate * 20 * share * back
    table = np.hstack([embed @ weights, seen[:, None]]).astype(np.float32)
    raw = Model(langs, table, bias, 1.0, 0.0, 0.0)
    found, known = raw.probabilities(pa.array([texts[i] for i in held], pa.string()))
    logits = np.log(np.maximum(found, 1e-300))
    loss = lambda t: -np.log(np.maximum(softmax(logits / t)[np.arange(len(held)), truth[held]], 1e-12)).mean()
    temperature = min(np.geomspace(0.5, 10, 41), key=loss)
    right = logits.argmax(axis=1) == truth[held]
    if not right.any():
        return Model(langs, table, bias, float(temperature), 0.0, 0.0)
    top = softmax(logits[right] / temperature).max(axis=1)
    threshold = min(float(np.quantile(top, REJECT)), HIGHEST_THRESHOLD)
    return Model(langs, table, bias, float(temperature), threshold, float(np.quantile(known[right], REJECT)) / 2)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame) -> Model | None:
    """Train on a bounded sample of the labelled rows that are not held out."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = labelled.groupBy("lang").count().orderBy("lang").collect()
    if not counts:
        return None
    each = max(1, min(PER_LANG, SAMPLE_ROWS // len(counts)))
    space = 1 << 20
    share = F.create_map(*[F.lit(x) for r in counts for x in (r[0], min(space, -(-each * space // r[1])))])
    drawn = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(space)) < share[F.col("lang")])
    rows = drawn.select("text", "lang").limit(2 * each * len(counts)).collect()
    return train([r[0] for r in rows], [r[1] for r in rows])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs(doc_id, text)`` with ``lang_pred``, ``score`` and ``rejected``; other columns go."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            letters = batch.column("letter").to_numpy(zero_copy_only=False)
            if model is None:
                best, top, letters = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            else:
                p, known = model.probabilities(batch.column("text"))
                best = [model.langs[k] if ok else UNKNOWN for k, ok in zip(p.argmax(axis=1), letters, strict=True)]
                top = np.where(letters, p.max(axis=1), 0.0)
            rejected = ~letters if model is None else ~letters | ~model.accepts(p, known)
            cols = [pa.array(best, pa.string()), pa.array(top), pa.array(rejected)]
            names = ["doc_id", "lang_pred", "score", "rejected"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", letter.alias("letter")).mapInArrow(
        predict, f"doc_id {kind}, lang_pred string, score double, rejected boolean"
    )


def keep_identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` without the rows that are rejected, all columns, decided in the scan without a join."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def accepted(texts: pa.Array) -> pa.Array:
        return pa.array(sent.value.accepts(*sent.value.probabilities(texts)), pa.bool_())

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.where(F.lit(False))
    return docs.where(letter & accepted(F.col("text")))
