from collections import Counter

from conftest import plan_of, rows_of

from ferrylog.llm import mixing


def frame(make, rows):
    return make(rows, "doc_id BIGINT, text STRING, source STRING, copies STRING, place INT")


def levels(sizes, weights=(5, 2, 1), most=3):
    """Targets by stopping sources and sharing the rest again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        free = sum(w[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else rest * w[s] / free for s in names}
        above = {s for s in names if target[s] > most * sizes[s] + 1e-9}
        if not above:
            return target
        full |= above


def test_targets_copies_and_the_mix(make):
    rows = [(i, "w " * (1 + i % 40), f"s{i % 3 if i % 2 else 0}", "c", 1) for i in range(3000)]
    rows += [(9000 + i, "one two", "tiny", "c", 1) for i in range(5)]
    rows += [(9100, None, None, "c", 1), (9101, "", None, "c", 1), (9102, " a\tb ", None, "c", 1), (None, "x y z", "s1", "c", 1)]
    rows += [(9200, "same row", "s2", "c", 1)] * 4 + [(9300, None, "nothing", "c", 1)]
    docs = frame(make, rows)
    got = mixing.shares(docs).collect()
    sizes = Counter()
    for r in got:
        sizes[r.source] += r.size
    assert len(got) == len(rows)
    want = levels(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    for source, target in want.items():
        assert abs(taken[source] - target) <= 45
    assert sorted(map(str, got)) == sorted(map(str, mixing.shares(docs.repartition(7)).collect()))

    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    per_row = Counter()
    for r in got:
        per_row[r.doc_id, r.source] += r.copies
    assert Counter((r.doc_id, r.source) for r in mixed.collect()) == +per_row


def test_an_empty_table_and_one_without_words(make):
    assert mixing.shares(frame(make, [])).count() == 0
    assert mixing.mix(frame(make, [])).count() == 0
    assert [tuple(r) for r in mixing.shares(frame(make, [(1, None, None, "c", 1)])).collect()] == [(1, None, 0, 0, 0.0, 0)]


def test_texts_are_not_shuffled_to_meet_a_short_list_of_copies(spark, make, monkeypatch):
    rows = [(i, "w " * (1 + i % 40), f"s{i % 3}", "c", 1) for i in range(300)] + [(900, "same row", "s2", "c", 1)] * 4
    rows += [(901, "x", None, "c", 1), (None, "x y z", "s1", "c", 1)]
    docs, threshold = frame(make, rows), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        mixed = mixing.mix(docs)
        assert "SortMergeJoin" not in plan_of(mixed)
        some = rows_of(mixed)
        monkeypatch.setattr(mixing, "COPIES_BYTES", 0)
        long = mixing.mix(docs)
        assert "SortMergeJoin" in plan_of(long)
        assert rows_of(long) == some
    finally:
        spark.conf.set(threshold, before)
