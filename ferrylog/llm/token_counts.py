"""Token counts with a digest cache.

A count depends on the text and the tokenizer only. Each text gets the SHA-256 digest of its content
(null as empty), each tokenizer one of its vocabulary file and settings. Digests found in the cache
table take its count; of the others, each distinct text is encoded once and appended. A second run over
the same texts encodes nothing, and a new tokenizer version finds none of the old counts.

The vocabulary file is read once on the driver and sent with the task, a few megabytes at most. Texts
whose characters are all common Latin ones are encoded by tiktoken with the ranks of the same file,
where both libraries agree and it is four times as fast; all others by tokenizers itself, also those on
whose white space the regex engine of tiktoken gives up.

Results in special cases: a null or empty text has no bytes and no tokens; special strings in a text
count as the tokenizer's default has it (one special token); rows with equal texts share an encoding;
an empty table gives no row and leaves the cache as it is. Texts are never truncated.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from importlib.metadata import version

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.staging import exists, stage

#: Fixed value: the pattern by which byte-level BPE of this kind cuts a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space, ASCII and Latin letters of the older Unicode versions, alike in both libraries.
UNCOMMON = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ]")
CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens bigint"


def tokenizer_digest(vocabulary: bytes) -> str:
    """Names a tokenizer: its file, the library's version and how it is called."""
    settings = f"tokenizers {version('tokenizers')}; no added tokens, no truncation, no padding;"
    return hashlib.sha256(settings.encode() + vocabulary).hexdigest()


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: visible ones for themselves, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def counter(vocabulary: bytes) -> Callable[[list[str]], list[int]]:
    """Counts the tokens of texts; kept for the life of a Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_buffer(vocabulary)
    slow.no_truncation()
    slow.no_padding()
    parts = json.loads(vocabulary)
    special = {x["content"]: x["id"] for x in parts["added_tokens"]}
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in t): i for t, i in parts["model"]["vocab"].items() if t not in special}
    fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def one(text: str) -> int:
        if not UNCOMMON.search(text):
            try:
                return len(fast.encode(text, allowed_special="all"))
            except ValueError:  # its regex engine gives up on very long runs of white space
                pass
        return len(slow.encode(text, add_special_tokens=False).ids)

    return lambda texts: [one(t) for t in texts]


def encode_counts(texts: DataFrame, vocabulary: bytes, tokenizer: str) -> DataFrame:
    """``(digest, tokenizer, n_tokens)`` of ``texts(digest, text)``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = counter(vocabulary)(batch.column("text").to_pylist())
            names = pa.array([tokenizer] * batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), names, pa.array(counts, pa.int64())], names=["digest", "tokenizer", "n_tokens"]
            )

    return texts.mapInArrow(encode, CACHE_SCHEMA)


def count_tokens(docs: DataFrame, vocabulary_path: str, cache: str, *, limit: int = 1024) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, a row per row; new counts are appended to ``cache``.

    ``cache`` is a Parquet folder that all executors reach; it is created when it is not there.
    """
    spark = docs.sparkSession
    with open(vocabulary_path, "rb") as file:
        vocabulary = file.read()
    tokenizer = tokenizer_digest(vocabulary)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))

    def known() -> DataFrame:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == tokenizer)
        return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    misses = keyed.select("digest", "text")
    if exists(spark, cache):
        misses = misses.join(known().select("digest"), "digest", "left_anti")
    misses = misses.groupBy("digest").agg(F.first("text").alias("text"))
    encode_counts(misses, vocabulary, tokenizer).write.mode("append").parquet(cache)
    sized = keyed.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "digest")
    # staged, so that the join has exchanges of its own, which AQE may split for a hot digest
    return sized.join(stage(known(), "counts"), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
