"""The corpus pipeline: five stages over documents, each one an operator of ``ferrylog.llm``.

Each stage reads what its predecessor wrote, so a lost executor costs a part of one stage only. All
stages but the last return the columns of documents. The result is not expressible as SQL, since the
first stage is a trained model and the last one a tokenizer.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ferrylog.llm import exact, langid, mixing, ngram_join, piece_codec
from ferrylog.staging import delete, new_folder, scratch

TOKENIZERS = os.environ.get("TOKENIZER_FOLDER") or os.path.dirname(public_tokenizers.path("piece_bpe_32k.model"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones have; those the model rejects go."""
    return langid.keep_identified(docs, langid.fit(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of texts that are equal without white space."""
    return exact.keep_distinct(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8 or more."""
    return ngram_join.keep_one(docs, ngram_join.Rule(words=5, num=80, den=100))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document may be taken up to three times."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_pieces, ids, ids_sha256, round_trip)`` of every document of the mix, the ids as the model's own tokenizer gives them."""
    return piece_codec.encode(docs, piece_codec.read_model(f"{TOKENIZERS}/piece_bpe_32k.model"), as_trained=True)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    What a stage stages on its way is deleted when its result is written, and so is the result of the stage
    before it: at any time two results are there at most.
    """
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, function in STAGES:
        path = new_folder(spark, name.split()[0].lower())
        with scratch(spark):
            rows = function(spark, docs, sf_dir)
            rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
