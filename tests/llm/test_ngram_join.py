import random

import numpy as np
import pytest
from conftest import DATA, plan_of

from ferrylog import staging
from ferrylog.llm import ngram_join
from ferrylog.llm.ngram_join import Rule, block_keys, common, link_classes, overlap_bound, packed, parity_bits
from ferrylog.llm.words import Words

from .conftest import classes, plain_words


def brute(rows, rule):
    sets = {}
    for i, text in rows:
        w = plain_words(text)
        n = rule.words
        sets[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    ids = [i for i in sets if sets[i]]
    linked = []
    for x, a in enumerate(ids):
        for b in ids[:x]:
            i = len(sets[a] & sets[b])
            if rule.den * i >= rule.num * (len(sets[a]) + len(sets[b]) - i):
                linked.append((a, b))
    roots = classes(list(sets), linked)
    return {(i, len(s), roots[i]) for i, s in sets.items()}


def variants(seed, count=300):
    r = random.Random(seed)
    bases = [[f"w{r.randrange(10**6)}" for _ in range(r.choice([5, 9, 20, 60, 200]))] for _ in range(10)]
    rows = []
    for i in range(count):
        words = list(r.choice(bases))
        for _ in range(r.randrange(max(1, len(words) // 12) + 2)):
            at = r.randrange(len(words)) if words else 0
            words[at : at + r.randrange(2)] = [f"x{r.randrange(50)}"][: r.randrange(2)]
        rows.append((3 * i, " ".join(words)))
    return rows


EDGES = [(9001, None), (9002, ""), (9003, " \t"), (9004, "A b"), (9005, "a B"), (9006, "É"), (9007, "é"), (9008, "a b")]


@pytest.mark.parametrize("rounds", [3, 0])
def test_classes_are_those_of_all_pairs(docs, monkeypatch, rounds):
    monkeypatch.setattr(ngram_join, "LEADER_ROUNDS", rounds)
    monkeypatch.setattr(ngram_join, "OPEN_ROWS", 8)
    monkeypatch.setattr(ngram_join, "TILE_ROWS", 16)
    rows = variants(rounds) + EDGES
    rule = Rule(4, 85, 100)
    assert {tuple(r) for r in link_classes(docs(rows), rule).collect()} == brute(rows, rule)


def test_documents_table(spark):
    frame = spark.read.parquet(str(DATA / "sf0.001" / "documents.parquet"))
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    for rule in (Rule(4, 85, 100), Rule()):
        assert {tuple(r) for r in link_classes(frame, rule).collect()} == brute(rows, rule)


def test_rows_without_id_repeated_rows_and_the_kept_one(docs):
    text = " ".join(f"w{i}" for i in range(100))
    frame = docs([(7, text), (7, text), (4, text + " end"), (None, text), (9, "else"), (9, text), (1, None)])
    got = sorted(map(tuple, link_classes(frame).collect()), key=str)
    assert got == sorted([(7, 96, 4), (7, 96, 4), (4, 97, 4), (None, 96, None), (9, 1, 4), (9, 96, 4), (1, 0, 1)], key=str)
    kept = ngram_join.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 4, None]
    assert link_classes(docs([])).count() == 0


@pytest.mark.parametrize("rule", [Rule(), Rule(4, 85, 100), Rule(3, 60, 100)])
def test_linking_sets_share_a_block_and_bounds_hold(rule):
    r = np.random.default_rng(1)
    for n in [*range(1, 60), 200, 1000]:
        a = np.unique(r.integers(1 << 62, size=n, dtype=np.uint64))
        gone = r.integers(0, n // 4 + 1)
        b = np.unique(np.r_[a[gone:], r.integers(1 << 62, size=r.integers(0, n // 8 + 1), dtype=np.uint64)])
        i = common(a, b)
        assert i == len(set(a.tolist()) & set(b.tolist()))
        bits = [np.frombuffer(parity_bits(x), dtype=np.uint8) for x in (a, b)]
        assert overlap_bound(len(a), len(b), *bits) >= i
        if len(b) and rule.links(i, len(a), len(b)) and i < max(len(a), len(b)):
            assert set(block_keys(a, rule).tolist()) & set(block_keys(b, rule).tolist())


def test_sets_with_empty_blocks_meet_all_the_same(monkeypatch):
    """Every link of small sets is found with a single seed too, by agreement in empty blocks."""
    monkeypatch.setattr(ngram_join, "MAX_SEEDS", 0)
    r, rule = np.random.default_rng(2), Rule(4, 85, 100)
    for _ in range(300):
        a = np.unique(r.integers(1 << 62, size=r.integers(6, 30), dtype=np.uint64))
        b = a[1:]
        if rule.links(len(b), len(a), len(b)):
            assert set(block_keys(a, rule).tolist()) & set(block_keys(b, rule).tolist())


@pytest.mark.parametrize("size", [512, 8])
def test_numbers_of_links_are_those_of_all_pairs(docs, monkeypatch, size):
    monkeypatch.setattr(ngram_join, "LINK_SETS", size)
    rule, rows = Rule(4, 85, 100), variants(7) + EDGES + [(9100, "A b")]
    sets = {i: {tuple(w[j : j + 4]) for j in range(len(w) - 3)} or {tuple(w)} - {()} for i, t in rows for w in [plain_words(t)]}
    near = lambda a, b: a and b and 100 * len(a & b) >= 85 * len(a | b)
    want = {(i, sum(j != i and bool(near(s, sets[j])) for j in sets)) for i, s in sets.items()}
    got = ngram_join.link_counts(docs(rows), rule).collect()
    assert {(r.doc_id, r.n_links) for r in got} == want and len(got) == len(rows)
    assert {tuple(r)[:3] for r in got} == brute(rows, rule)


def test_numbers_of_links_of_repeated_rows_and_rows_without_id(docs):
    text = " ".join(f"w{i}" for i in range(100))
    frame = docs([(7, text), (7, text), (4, text + " end"), (None, text), (9, "else"), (9, text), (1, None)])
    got = sorted(((r.doc_id, r.n_shingles, r.n_links) for r in ngram_join.link_counts(frame).collect()), key=str)
    want = [(7, 96, 3), (7, 96, 3), (4, 97, 3), (None, 96, 0), (9, 1, 0), (9, 96, 3), (1, 0, 0)]
    assert got == sorted(want, key=str)


def test_postings_are_dealt_once_and_sets_too_far_apart_are_not_shuffled(docs, monkeypatch):
    plans, verified = [], []

    def stage(df, label, **more):
        plans.append(plan_of(df))
        return staging.stage(df, label, **more)

    def verify(self, pairs, sets, known=ngram_join.NgramJoin.verified):
        verified.append({tuple(r) for r in pairs.collect()})
        return known(self, pairs, sets)

    monkeypatch.setattr(ngram_join, "stage", stage)
    monkeypatch.setattr(ngram_join.NgramJoin, "verified", verify)
    words = [f"w{i}" for i in range(400)]
    # the same sentences in 300 words, and others in 100: in a common tile, yet too far apart
    rows = [(i, " ".join(words[:300] + [f"x{i}_{j}" for j in range(100)])) for i in range(40)]
    rows += [(100 + i, " ".join(words + [f"y{i}"])) for i in range(3)]
    rule = Rule(4, 85, 100)
    assert {tuple(r) for r in link_classes(docs(rows), rule).collect()} == brute(rows, rule)
    assert sum("deal(" in plan for plan in plans) == 1
    near = {(a, b) for pairs in verified for a, b in pairs}
    assert near and all(a >= 100 and b >= 100 for a, b in near)


def test_words_on_which_sums_of_powers_collide(docs):
    """Thue-Morse words and their complements have equal sums of powers for every base and letter table."""
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    got = ngram_join.link_classes(docs([(1, f"x {word} y z"), (2, f"x {other} y z"), (3, f"x {word} y z")])).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 1), (2, 1, 2), (3, 1, 1)]
    raw = np.frombuffer(f"{word} {other} abcdefgh abcdefg hgfedcba abcdefghi".encode(), dtype=np.uint8)
    assert len(set(Words(raw, np.array([0, len(raw)])).hashes.tolist())) == 6


def test_no_array_of_hashes_is_staged_and_postings_move_as_arrays(docs, monkeypatch):
    """Arrays are longer than texts, and postings are most of the rows."""
    staged, plans = {}, {}

    def stage(df, label, **more):
        staged.setdefault(label, set()).update(kind for _, kind in df.dtypes)
        plans[label] = plan_of(df)
        return staging.stage(df, label, **more)

    monkeypatch.setattr(ngram_join, "stage", stage)
    rows = variants(5, 60)
    rule = Rule(4, 85, 100)
    got = ngram_join.link_counts(docs(rows), rule).collect()
    assert {tuple(r)[:3] for r in got} == brute(rows, rule)
    assert "sets" in staged and not any("array" in kind for kinds in staged.values() for kind in kinds)
    # the one exchange below the window is that of the arrays
    below = plans["members"].split("Window")[-1].split("MapInArrow")[0]
    assert below.count("Exchange") == 1 and below.index("Generate") < below.index("Exchange")


@pytest.mark.parametrize("buckets", [1, 7, 3000])
def test_packed_postings_are_those_dealt(buckets):
    r = np.random.default_rng(3)
    keys = r.integers(1 << 64, size=5000, dtype=np.uint64)
    names = np.repeat(r.integers(-(1 << 62), 1 << 62, size=50), 100)
    keys[100:200] = keys[:100]  # two sets in the same tiles
    got = packed(keys, names, buckets).to_pydict()
    assert len(set(got["bucket"])) == len(got["bucket"]) and set(got["bucket"]) <= set(range(buckets))
    rows = [(b, k, n) for b, ks, ns in zip(*got.values(), strict=True) for k, n in zip(ks, ns, strict=True)]
    low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32).tolist()
    bucket = [(k >> 32) * buckets >> 32 for k in keys.tolist()]
    assert sorted(rows) == sorted(zip(bucket, low, names.tolist(), strict=True))
