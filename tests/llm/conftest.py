import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def classes(nodes, linked):
    """Smallest node of each node's component, by plain union-find."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.fixture
def docs(make):
    """(doc_id, text) pairs as documents, beside columns whose names operators use inside."""

    def build(rows):
        extra = ("en", "s", 7, "n", "k", 1.5)
        schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, name STRING, `key` STRING, size DOUBLE"
        return make([(i, t, *extra) for i, t in rows], schema)

    return build
