import numpy as np
import pytest

from ferrylog.llm import embedding_forest

from .conftest import classes


def brute(rows):
    good = {i: np.array(v, dtype=float) for i, v in rows if v and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v)}
    good = {i: v for i, v in good.items() if v.any()}
    ids = sorted(good)
    x = np.array([good[i] for i in ids])
    n = np.linalg.norm(x, axis=1)
    near = x @ x.T / np.outer(n, n) >= 0.95
    np.fill_diagonal(near, False)
    links = dict(zip(ids, near.sum(axis=1).tolist(), strict=True))
    roots = classes([i for i, _ in rows], [(ids[a], ids[b]) for a, b in np.argwhere(near)])
    return {(i, links.get(i, 0), roots[i], roots[i] == i) for i, _ in rows}


@pytest.mark.parametrize("small", [False, True])
def test_links_and_components_are_those_of_all_pairs(make, monkeypatch, small):
    if small:  # leaves are cut on, and what is left of them is compared in several tiles
        monkeypatch.setattr(embedding_forest, "LEAF", 40)
        monkeypatch.setattr(embedding_forest, "LARGEST_LEAF", 30)
        monkeypatch.setattr(embedding_forest, "TILE", 20)
    r = np.random.default_rng(5)
    centres = r.normal(size=(30, 8))
    rows = [(int(i) * 2, (centres[i % 30] + r.normal(size=8) * (0.12 if i % 3 else 1)).tolist()) for i in range(500)]
    rows += [(2001 + i, centres[0].tolist()) for i in range(60)]  # equal ones
    rows += [(3001 + i, (centres[1] + r.normal(size=8) * 0.02).tolist()) for i in range(80)]  # a dense spot
    rows += [(4001, None), (4002, []), (4003, [0.0] * 8), (4004, [1.0, None] * 4), (4005, [float("nan")] * 8)]
    rows += [(4006, [float("inf")] * 8), (4007, [1.0] * 3), (4008, (2 * centres[0]).tolist())]
    frame = make([(i, v, "x") for i, v in rows], "vec_id BIGINT, embedding ARRAY<DOUBLE>, rep STRING")
    got = {tuple(x) for x in embedding_forest.link_vectors(frame).collect()}
    want = brute(rows)
    found, wanted = sum(x[1] for x in got), sum(x[1] for x in want)
    assert found >= 0.99 * wanted
    assert all(a[1] <= b[1] for a, b in zip(sorted(got), sorted(want), strict=True))  # no link below the threshold
    if found == wanted:
        assert got == want


def test_rows_without_id_repeated_rows_and_an_empty_table(make):
    schema = "vec_id BIGINT, embedding ARRAY<FLOAT>"
    rows = [(3, [1.0, 0.0]), (3, [1.0, 0.0]), (None, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (2, [0.0, 1.0])]
    got = sorted(map(tuple, embedding_forest.link_vectors(make(rows, schema)).collect()), key=str)
    want = [(3, 2, 1, False)] * 2 + [(None, 0, None, False), (1, 1, 1, True), (2, 2, 1, False), (2, 1, 1, False)]
    assert got == sorted(want, key=str)
    assert embedding_forest.link_vectors(make([], schema)).count() == 0
    assert [tuple(r) for r in embedding_forest.link_vectors(make([(1, None)], schema)).collect()] == [(1, 0, 1, True)]


def test_vectors_of_every_length_are_linked(make):
    rows = [(i, [1.0, 0.01 * i, 0.0]) for i in range(6)]
    rows += [(10 + i, [0.01 * i, 1.0]) for i in range(3)] + [(20, [1.0] * 5), (21, [1.0] * 5), (0, [0.0, 1.0])]
    got = embedding_forest.link_vectors(make(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")).collect()
    # 0 has a vector of each length, which joins their components
    want = [(i, 5, 0, i == 0) for i in range(6)] + [(0, 3, 0, True)] + [(10 + i, 3, 0, False) for i in range(3)]
    assert sorted(map(tuple, got)) == sorted([*want, (20, 1, 20, True), (21, 1, 20, False)])


def test_very_large_and_very_small_components(make):
    rows = [(i, [1e200, 1e200 * (1 + 0.01 * i)]) for i in range(3)] + [(9, [1e200, -1e200])]
    rows += [(10 + i, [1e-200, 1e-200 * (1 + 0.01 * i)]) for i in range(2)]
    got = embedding_forest.link_vectors(make(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")).collect()
    assert sorted(map(tuple, got)) == [(0, 4, 0, True), *((i, 4, 0, False) for i in (1, 2)), (9, 0, 9, True), (10, 4, 0, False), (11, 4, 0, False)]


@pytest.mark.parametrize("kind", ["FLOAT", "DOUBLE"])
def test_recall_in_64_dimensions_over_several_levels(make, monkeypatch, kind):
    """Links planted just above the threshold, where the trees part most; 2,400 vectors in leaves of 40: six levels."""
    monkeypatch.setattr(embedding_forest, "LEAF", 40)
    monkeypatch.setattr(embedding_forest, "LARGEST_LEAF", 320)
    r = np.random.default_rng(17)
    x = r.normal(size=(2400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = r.normal(size=(800, 64))
    off -= (off * x[:800]).sum(axis=1, keepdims=True) * x[:800]
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    cosine = r.uniform(0.951, 0.98, size=(800, 1))
    x[1600:] = cosine * x[:800] + np.sqrt(1 - cosine**2) * off
    x = x.astype(np.float32 if kind == "FLOAT" else np.float64).astype(np.float64)
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    got = {row.vec_id: row.n_links for row in embedding_forest.link_vectors(make(rows, f"vec_id BIGINT, embedding ARRAY<{kind}>")).collect()}
    near = x @ x.T / np.outer(*[np.linalg.norm(x, axis=1)] * 2) >= 0.95
    np.fill_diagonal(near, False)
    wanted = near.sum(axis=1)
    assert wanted.sum() >= 1600 and all(got[i] <= n for i, n in enumerate(wanted))
    assert sum(got.values()) >= 0.9 * wanted.sum(), sum(got.values()) / wanted.sum()
    print(f"recall {sum(got.values()) / wanted.sum():.4f}")
