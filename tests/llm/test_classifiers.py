"""Held-out accuracy of the trained operators, and their special cases."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from conftest import DATA
from pyspark.sql import functions as F

from ferrylog.llm import langid, ordinal_quality, toxicity
from ferrylog.llm.features import Rows, features, word_presence, word_shapes

EDGES = [(1, None), (2, ""), (3, " \n"), (4, "123 !!"), (None, "x"), (5, "word " * 60_000), (5, "same"), (5, "same")]


def test_languages(spark, docs):
    table = spark.read.parquet(str(DATA / "sf0.01" / "documents.parquet"))
    model = langid.fit(table)
    assert model.langs == ["de", "en", "es", "fr"]
    out = langid.held_out(F.col("doc_id")).alias("out")
    truth = table.select("doc_id", "lang", out).join(langid.identify(table, model), "doc_id").where("out").collect()
    assert len(truth) > 200
    assert sum(r.lang == r.lang_pred for r in truth) >= 0.99 * len(truth)
    assert sum(r.rejected for r in truth) <= 0.01 * len(truth)
    assert all(0 <= r.score <= 1 for r in truth)

    strange = [(20, "кто это такой и почему"), (21, "漢字仮名交じり文です")]
    frame = docs(EDGES + strange)
    got = langid.identify(frame, model).collect()
    assert len(got) == len(frame.collect())
    assert {(r.lang_pred, r.score, r.rejected) for r in got if r.doc_id in (1, 2, 3, 4)} == {("und", 0.0, True)}
    assert all(r.rejected for r in got if r.doc_id in (20, 21))
    kept = langid.keep_identified(frame, model)
    assert kept.columns == frame.columns
    good = sorted(str(r.doc_id) for r in got if not r.rejected)
    assert sorted(str(r.doc_id) for r in kept.collect()) == good
    assert langid.identify(docs([]), model).count() == 0


def test_languages_without_labels(docs):
    frame = docs([(1, "the text")]).withColumn("lang", F.lit(None).cast("string"))
    assert langid.fit(frame) is None
    assert [tuple(r) for r in langid.identify(frame, None).collect()] == [(1, "und", 0.0, True)]
    assert langid.keep_identified(frame, None).count() == 0


def made(seed, count):
    """Texts of common words; bad ones hold a word of a small list, low ones symbols or repeats."""
    r = random.Random(seed)
    rows = []
    for i in range(count):
        words = [f"w{r.randrange(400)}" for _ in range(r.randrange(5, 120))]
        toxic, low = i % 4 == 0, i % 4 == 1
        if toxic:
            words.insert(r.randrange(len(words)), r.choice(["vile", "scorn", "Spite"]))
        if low:
            words = [w + "%%%" for w in words] if r.random() < 0.5 else [w for w in words for _ in range(6)]
        rows.append((i, " ".join(words), int(toxic), int(not low), "en" if i % 8 else "de"))
    return rows


def split(frame):
    """Documents and labels; the documents have a column of a clashing name."""
    return frame.select("doc_id", "text", "lang", F.lit(1).alias("named")), frame.select("doc_id", "toxic", "quality")


def test_toxicity_chain(make, docs):
    schema = "doc_id BIGINT, text STRING, toxic INT, quality INT, lang STRING"
    names = {"toxic": F.col("toxic") == 1, "toxic_en": (F.col("toxic") == 1) & (F.col("lang") == "en")}
    chain = toxicity.fit(*split(make(made(1, 4000), schema)), names)
    test = make([(i + 5000, *row[1:]) for i, row in enumerate(made(2, 400))], schema)
    got = test.join(toxicity.score(test, chain, list(names)).withColumnRenamed("toxic", "flag"), "doc_id").collect()
    assert sum(r.flag == bool(r.toxic) for r in got) >= 0.97 * len(got)
    assert {r.p_toxic_en > 0.5 for r in got if not r.flag} == {False}

    rows = toxicity.score(docs(EDGES), chain, list(names)).collect()
    assert len(rows) == len(EDGES) and not any(r.toxic for r in rows if r.doc_id in (1, 2, 3))
    assert toxicity.score(docs([]), chain, list(names)).count() == 0
    unlabelled = make([(1, "a", None, None, None)], schema)
    assert toxicity.fit(*split(unlabelled), names) is None
    assert [tuple(r) for r in toxicity.score(unlabelled, None, ["toxic"]).collect()] == [(1, 0.0, False)]


def test_later_models_get_predictions_made_out_of_fold():
    """The first category cannot be told from the words, so out of fold it says little to the second."""
    r = np.random.default_rng(3)
    rows = features(pa.array([f"only{i} " * 3 for i in range(300)]), word_presence)
    first = r.integers(0, 2, 300)
    chain = toxicity.fit_chain(rows, np.stack([first, first], axis=1), ["a", "b"])
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1
    assert abs(chain.weights[1][-1]) < 2


def test_ordinal_quality(make, docs):
    schema = "doc_id BIGINT, text STRING, toxic INT, quality INT, lang STRING"
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))
    model = ordinal_quality.fit(*split(make(made(4, 1500), schema)), grade, 2)
    assert model.thresholds[0] < model.thresholds[1]
    test = make(made(5, 400), schema)
    got = test.join(ordinal_quality.score(test, model, 1), "doc_id").collect()
    assert sum(r.selected == bool(r.quality) for r in got) >= 0.97 * len(got)
    mean = {g: np.mean([r.expected_grade for r in got if r.quality * (2 - r.toxic) == g]) for g in (0, 1, 2)}
    assert mean[0] < 0.4 < mean[1] < 1.7 < mean[2]

    rows = {(r.doc_id, r.expected_grade, r.selected) for r in ordinal_quality.score(docs(EDGES[:3]), model, 1).collect()}
    assert rows == {(1, 0.0, False), (2, 0.0, False), (3, 0.0, False)}
    assert ordinal_quality.score(docs(EDGES), model, 2).count() == len(EDGES)
    assert ordinal_quality.score(docs([]), model, 1).count() == 0
    assert ordinal_quality.fit(*split(make([(1, "a", None, None, None)], schema)), grade, 2) is None
    assert [r.selected for r in ordinal_quality.score(docs([(1, "a")]), None, 1).collect()] == [False]


def test_ordinal_slopes_are_those_of_the_likelihood():
    rows = Rows(np.array([0, 1, 2, 3, 4]), np.array([0, 0, 1, 1]), np.ones(4))
    model = ordinal_quality.fit_ordinal(rows, np.array([0, 1, 1, 2]), 2)
    p = model.tails(rows)
    assert (p[2:, 0] > p[:2, 0]).all() and (p[:, 0] > p[:, 1]).all()


def test_word_features():
    rows = features(pa.array(["a b a", None, "A\tB", "c%% c%%"]), word_presence)
    sets = [set(rows.buckets[a:b]) for a, b in zip(rows.bounds[:-1], rows.bounds[1:], strict=True)]
    assert sets[0] == sets[2] and len(sets[0]) == 2 and not sets[1] and len(sets[3]) == 1
    shapes = features(pa.array(["a b a", "c%% c%%"]), word_shapes)
    assert np.diff(shapes.bounds).tolist() == [1, 2]


def test_language_id_needs_little_memory_beside_the_texts():
    """A worker's share of an executor's memory: a few slices' worth, however many rows come at once."""
    weights = np.random.default_rng(0).random((langid.BUCKETS, 3)).astype(np.float32)
    model = langid.Model(["a", "b"], weights, np.zeros(2), 1.0, 0.0, 0.0)
    texts = pa.array([f"some words {i} of a text " * 100 for i in range(3000)])
    tracemalloc.start()
    found, known = model.probabilities(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.shape == (3000, 2) and known.shape == (3000,)
    assert peak < 40e6
