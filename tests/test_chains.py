"""Greedy pieces, against a walk along each partition."""

from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrylog.operators import chains

LOG = "topic STRING, part INT, off BIGINT, size BIGINT"
COMMITS = "topic STRING, part INT, seq BIGINT, at BIGINT"

few = settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
spots = st.tuples(st.sampled_from("ab"), st.integers(0, 1), st.integers(0, 60))
cuts = {"span": st.integers(1, 9), "group": st.integers(2, 4)}


def in_order(rows):
    return sorted(rows, key=lambda row: tuple(map(str, row)))


def walked_fetches(log, budget):
    out = []
    for topic, part in sorted({row[:2] for row in log}):
        own = [(off, size or 0) for t, p, off, size in sorted(log, key=lambda row: row[:3]) if (t, p) == (topic, part)]
        pieces = []
        for off, size in own:
            if not pieces or pieces[-1][1] + size > budget:
                pieces.append([off, 0])
            pieces[-1][1] += size
        ends = [first for first, _ in pieces[1:]] + [own[-1][0] + 1]
        out += [(topic, part, n, first, end, total) for n, ((first, total), end) in enumerate(zip(pieces, ends, strict=True))]
    return in_order(out)


def walked_saves(commits, every):
    out, last = [], {}
    for topic, part, seq, at in sorted(commits, key=lambda row: row[:3]):
        if at is not None and ((topic, part) not in last or at >= last[topic, part] + every):
            last[topic, part] = at
            out.append((topic, part, seq, at))
    return in_order(out)


@few
@given(log=st.dictionaries(spots, st.one_of(st.none(), st.integers(0, 12)), max_size=60), budget=st.integers(1, 30), **cuts)
def test_fetches(make, log, budget, span, group):
    rows = [(*spot, size) for spot, size in log.items()]
    assert rows_of(chains.greedy_fetches(make(rows, LOG), budget, size="size", span=span, group=group)) == walked_fetches(rows, budget)


@few
@given(log=st.dictionaries(spots, st.one_of(st.none(), st.integers(-20, 60)), max_size=60), every=st.integers(1, 25), **cuts)
def test_saves_whose_times_go_back(make, log, every, span, group):
    rows = [(*spot, at) for spot, at in log.items()]
    got = chains.saves(make(rows, COMMITS), every, at=F.col("at"), span=span, group=group)
    assert rows_of(got.select("topic", "part", "seq", "at")) == walked_saves(rows, every)


def test_many_levels_and_a_piece_over_many_segments(make):
    rows = [("a", 0, off, (off * 7919) % 97) for off in range(700)] + [("a", 1, 0, 5_000), ("a", 1, 1, 0), ("a", 1, 9, 1)]
    for budget in (50, 900, 1_000_000):
        got = chains.greedy_fetches(make(rows, LOG), budget, size="size", span=4, group=3)
        assert rows_of(got) == walked_fetches(rows, budget)


def test_an_empty_log(make):
    assert rows_of(chains.greedy_fetches(make([], LOG), 10, size="size")) == []
    assert rows_of(chains.saves(make([], COMMITS), 10, at=F.col("at"))) == []


def test_functions_hold_no_more_than_the_marks_that_can_come_in():
    """Of 1,000 rows of one byte and a budget of ten, ten marks can come in from before."""
    import pandas as pd

    cum = range(5_001, 6_001)
    rows = pd.DataFrame({"off": range(1_000), "__begin": [c - 1 for c in cum], "__reach": list(cum), "__most": 5_010})
    upto, out = chains._function_of(rows, "off", 10)
    assert len(upto) == len(out) <= 12
