import re

from pyspark.sql import functions as F

from ferrylog.llm import exact


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


def brute(rows):
    out = []
    for doc_id, text in rows:
        same = [(-len(t or ""), i) for i, t in rows if norm(t) == norm(text)]
        best = min(same, key=lambda x: (x[0], x[1] is None, x[1] or 0))
        out.append((doc_id, best[1], len(same), (-len(text or ""), doc_id) == best))
    return sorted(out, key=str)


ROWS = [
    (5, "a b c"), (3, "ab\tc"), (9, "a  b  c"), (1, "abcd"), (2, None), (4, ""), (6, " \n "), (7, "é" * 70), (8, "é" * 69),
    (10, "é" * 35 + " " + "é" * 35), (11, "x" * 5000), (12, "x" * 2500 + " " + "x" * 2500), (13, "x" * 4999 + "y"),
    (14, "y" + "x" * 4999), (None, "lonely"), (None, "abc"), (15, "😀" * 9), (16, "😀 " * 9), (17, " a"),
]


def test_equal_texts_of_all_kinds(docs):
    for chars in (1024, 7):
        got = exact.dedup(docs(ROWS), chars=chars).select("doc_id", "keep_id", "group_size", "kept")
        assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS)


def test_blocks_with_the_same_hash_are_told_apart(docs):
    weak = lambda block: F.length(block).cast("bigint") % 2
    rows = [r for r in ROWS if r[0] is not None and len(r[1] or "") < 100]
    got = exact.dedup(docs(rows), chars=3, hasher=weak).select("doc_id", "keep_id", "group_size", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_repeated_rows_stand_together_and_extra_columns_stay(docs):
    frame = docs([(1, "a b"), (1, "a b"), (2, "ab"), (3, "z"), (2, "other")])
    got = exact.keep_distinct(frame)
    assert got.columns == frame.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, "a b"), (1, "a b"), (2, "other"), (3, "z")]


def test_an_empty_table_gives_no_row(docs):
    assert exact.dedup(docs([])).count() == 0


def test_the_sql_of_the_query_agrees_on_rows_of_all_kinds(docs):
    """Repeated and missing ids too, which the given tables do not have."""
    import duckdb

    from ferrylog.llm.queries import EXACT_SQL

    rows = [(1, "a b"), (1, "ab"), (None, "x y"), (None, "xy"), (None, None), (2, "q"), (2, "q"), (3, "q "), (4, "")]
    base = duckdb.connect()
    base.execute("CREATE TABLE docs (doc_id BIGINT, text VARCHAR)")
    base.executemany("INSERT INTO docs VALUES (?, ?)", rows)
    want = base.execute(EXACT_SQL.format(docs="docs")).fetchall()
    assert sorted(map(tuple, exact.dedup(docs(rows)).collect()), key=str) == sorted(want, key=str)
