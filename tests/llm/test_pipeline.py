"""The pipeline against plain counterparts of its stages, and on rows of all kinds."""

from collections import Counter

import pyarrow as pa
import pytest
from conftest import DATA
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from ferrylog.llm import langid, mixing, ngram_join, piece_codec
from ferrylog.llm.ngram_join import Rule
from ferrylog.session import bounded_batches
from ferrylog.staging import app_folder, children, stage

from .test_exact import brute as exact_brute
from .test_ngram_join import brute as ngram_brute


def staged(spark, docs, count):
    for _, function in corpus_pipeline.STAGES[:count]:
        docs = function(spark, docs, "")
    return docs


def test_stages_on_the_documents_table(spark):
    folder = str(DATA / "sf0.001")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = langid.fit(docs)
    good = {r.doc_id for r in langid.identify(docs, model).collect() if not r.rejected}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    kept = [i for i, keep, _, _ in exact_brute(list(texts.items())) if i == keep]
    kept = {i for i, _, c in ngram_brute([(i, texts[i]) for i in kept], Rule()) if i == c}
    left = staged(spark, docs, 3)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == kept

    copies = Counter({r.doc_id: r.copies for r in mixing.shares(left).collect()})
    library = SentencePieceProcessor(model_file=f"{corpus_pipeline.TOKENIZERS}/piece_bpe_32k.model")
    before = set(children(spark, app_folder(spark)))
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r.doc_id for r in got) == +copies
    ids = {i: library.encode(texts[i]) for i in {r.doc_id for r in got}}
    assert all(list(r.ids) == ids[r.doc_id] and r.round_trip for r in got)
    # what is left in the shared folder is the result alone
    assert len(set(children(spark, app_folder(spark))) - before) == 1


def test_rows_of_all_kinds(spark, make):
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, copies STRING, label INT"
    texts = [None, "", "5 5", "ein Text", "ein Text", "einText", None, "una casa grande", "x " * 40_000]
    rows = [(i if i % 4 else None, t, "de" if i % 2 else None, None if i % 3 else "s", None, "c", 1) for i, t in enumerate(texts * 3)]
    docs = make(rows, schema)
    for _, function in corpus_pipeline.STAGES[:-1]:
        after = stage(function(spark, docs, ""), "test")
        assert after.columns == docs.columns
        docs = after
    assert staged(spark, make([], schema), 5).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count() <= 3 * len(rows)


BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def own_bound(spark):
    """The session without a bound of its own on Arrow batches; afterwards as it was."""
    before = spark.conf.getAll.get(BATCH_KEY)
    spark.conf.unset(BATCH_KEY)
    yield
    spark.conf.unset(BATCH_KEY) if before is None else spark.conf.set(BATCH_KEY, before)


def largest_batch(docs):
    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    return docs.mapInArrow(measure, "size bigint").agg(F.max("size")).first()[0]


@pytest.mark.parametrize("operator", [
    lambda docs: langid.keep_identified(docs, langid.Model([], None, None, 1.0, 0.0, 0.0)),
    lambda docs: langid.identify(docs, None),
    lambda docs: ngram_join.NgramJoin(docs, Rule()),
    lambda docs: piece_codec.encode(docs, b""),
])
def test_texts_reach_python_in_batches_of_bounded_size(spark, own_bound, operator):
    """An executor's memory beside its heap holds some batches of each task, on both sides."""
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("abcdefghi "), 500).alias("text"))
    assert largest_batch(docs) > 12e6
    operator(docs)
    assert largest_batch(docs) < 5e6


def test_a_bound_that_the_session_has_stays(spark, own_bound):
    spark.conf.set(BATCH_KEY, "9m")
    bounded_batches(spark)
    assert spark.conf.get(BATCH_KEY) == "9m"


def test_results_do_not_depend_on_the_size_of_batches(spark, own_bound, docs):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words + [f"x{i % 7}", f"y{i % 5}"])) for i in range(40)] + [(50, None), (51, "")]
    rule = Rule(4, 85, 100)
    whole = sorted(map(tuple, ngram_join.link_counts(docs(rows), rule).collect()))
    spark.conf.set(BATCH_KEY, "1k")  # groups come in many pieces
    assert sorted(map(tuple, ngram_join.link_counts(docs(rows), rule).collect())) == whole
    assert {r[:3] for r in whole} == ngram_brute(rows, rule)
