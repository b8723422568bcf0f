import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrylog.llm import token_counts
from ferrylog.llm.queries import TOKENIZERS

VOCABULARY = f"{TOKENIZERS}/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def vocabulary():
    with open(VOCABULARY, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(vocabulary)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="aÉz ß\n\t'.,09-s<|endoftx>", max_size=60)))
def test_counts_are_those_of_the_library(vocabulary, library, text):
    assert token_counts.counter(vocabulary)([text]) == [library(text)]


def test_cache(docs, library, folder, spark):
    texts = [None, "", "a b", "a b", "x<|endoftext|>y", "你好   мир", "word " * 3000, "y" * 20000, "don't  stop\n\n"]
    rows = list(enumerate(texts)) + [(None, "a b")]
    want = {(i, len((t or "").encode()), library(t), library(t) > 1024) for i, t in rows}
    first = token_counts.count_tokens(docs(rows), VOCABULARY, folder)
    assert {tuple(r) for r in first.collect()} == want
    assert spark.read.parquet(folder).count() == len({t or "" for t in texts})
    # a second run encodes only what is new
    again = token_counts.count_tokens(docs([*rows, (50, "new text")]), VOCABULARY, folder)
    assert {tuple(r) for r in again.collect()} == want | {(50, 8, library("new text"), False)}
    assert spark.read.parquet(folder).count() == len({t or "" for t in texts}) + 1
    assert token_counts.count_tokens(docs([]), VOCABULARY, folder).count() == 0


def test_counts_of_another_tokenizer_are_not_taken(docs, folder, spark, vocabulary):
    digest = "digest binary, tokenizer string, n_tokens bigint"
    spark.sql("SELECT unhex(sha2('a b', 256)) AS digest, 'another' AS tokenizer, 99L AS n_tokens").write.parquet(folder)
    assert spark.read.schema(digest).parquet(folder).count() == 1
    assert [r.n_tokens for r in token_counts.count_tokens(docs([(1, "a b")]), VOCABULARY, folder).collect()] == [2]
    assert token_counts.tokenizer_digest(vocabulary) != token_counts.tokenizer_digest(vocabulary + b" ")


@pytest.mark.parametrize("space", [" ", "\n"])
def test_very_long_runs_of_white_space(vocabulary, library, space):
    text = "a" + space * 1_200_000 + "b c"
    assert token_counts.counter(vocabulary)([text, "a b"]) == [library(text), library("a b")]
