import math

import numpy as np
import pytest
from conftest import DATA

from ferrylog.llm import queries, whitening


def brute(rows):
    """Moments by plain integers, eigenvectors by a dense solver."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    out = {}
    for dim in {len(x) for _, x in kept}:
        fit = sorted({tuple(x) for _, x in kept if len(x) == dim})
        n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
        centred = np.array(fit, dtype=float) - np.array(sums) / n
        values, vectors = np.linalg.eigh(centred.T @ centred / n)
        out[dim] = n, sums, values[::-1], vectors[:, ::-1]
    return kept, out


def check(got, rows, close=1e-9):
    kept, facts = brute(rows)
    by_dim = {}
    for row, (i, x) in zip(sorted(got, key=lambda r: (r.vec_id, r.component)), [p for p in sorted(kept) for _ in range(4)], strict=True):
        n, sums, values, vectors = facts[len(x)]
        assert (row.vec_id, row.n) == (i, n)
        assert row.deviation == row.deviation_exact == sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        k = row.component - 1
        want = (np.array(x) - np.array(sums) / n) @ vectors[:, k] / np.sqrt(values[k])
        by_dim.setdefault((len(x), k), []).append((row.whitened, want))
        assert abs(row.explained - values[k] / values.sum()) < 1e-12
        assert row.identity_error < 1e-12
    for pairs in by_dim.values():
        a, b = np.array(pairs).T
        assert np.abs(a - np.sign(a @ b) * b).max() < close


def test_components_are_those_of_a_dense_solver_on_the_embeddings(spark):
    folder = str(DATA / "sf0.01")
    given = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    got = queries.op12_whitening(spark, folder).collect()
    assert len(got) == 4 * len(given)
    check(got, [(r.vec_id, r.embedding) for r in given])


def test_lengths_copies_and_rows_without_numbers(make):
    r = np.random.default_rng(3)
    rows = [(i, (r.normal(size=5) * [5, 3, 2, 1, 0.5]).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)] + [(200 + i, (r.normal(size=4) * [9, 5, 3, 1]).tolist()) for i in range(30)]
    bad = [(300, None), (301, []), (302, [1.0, None]), (303, [float("nan")] * 5), (304, [float("inf")] * 5), (305, [1e300] * 5)]
    frame = make([(i, v, 1.0, "n") for i, v in rows + bad], "vec_id BIGINT, embedding ARRAY<DOUBLE>, x DOUBLE, n STRING")
    check(whitening.whiten(frame).collect(), rows)


def test_directions_without_variance_are_no_components(make):
    schema = "vec_id BIGINT, embedding ARRAY<FLOAT>"
    flat = [(i, [float(i), 2.0 * i, 7.0]) for i in range(10)] + [(None, [0.0, 0.0, 7.0])]
    got = whitening.whiten(make(flat, schema)).collect()
    assert [r.component for r in got] == [1] * 11
    assert abs(got[0].explained - 1) < 1e-12
    assert sum(r.vec_id is None for r in got) == 1
    assert whitening.whiten(make([(1, [1.0]), (2, [1.0])], schema)).count() == 0
    assert whitening.whiten(make([], schema)).count() == 0


def test_deviations_beyond_64_bits(make):
    rows = [(1, [2.0**40, 0.0]), (2, [0.0, 1.0]), (3, [-(2.0**40), 5.0])]
    got = whitening.whiten(make(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")).collect()
    exact = {r.vec_id: (r.deviation, int(r.deviation_exact)) for r in got}
    assert exact == {1: (None, (3 * 2**48) ** 2 + 1536**2), 2: ((768 - 1536) ** 2,) * 2, 3: (None, (3 * 2**48) ** 2 + (3840 - 1536) ** 2)}


@pytest.mark.parametrize("gap", [1.0, 1e-3, 1e-7])
@pytest.mark.parametrize("dim", [1, 3, 9, 50, 200])
def test_eigenvectors_with_close_values(dim, gap):
    r = np.random.default_rng(dim)
    q, _ = np.linalg.qr(r.normal(size=(dim, dim)))
    values = 100 * np.arange(dim, 0, -1.0) ** (2 * gap)
    a = q * values @ q.T
    passes = []

    def apply(block):
        passes.append(1)
        return a @ block

    got, vectors = whitening.leading(apply, dim, 4, float(values.sum()))
    k = min(4, dim)
    assert np.abs(got - values[:k]).max() < 1e-11 * values[0]
    assert np.linalg.norm(a @ vectors - vectors * got, axis=0).max() < 1e-11 * values[0]
    assert len(passes) < 400


def test_sums_of_many_tasks_are_exact_and_make_no_row_for_each_dimension(make, spark):
    """Arrays are added as they are; before, each task made a row of every dimension at every product."""
    r = np.random.default_rng(8)
    rows = [(i, r.normal(size=6).tolist()) for i in range(90)]
    x = spark.createDataFrame(rows, "vec_id BIGINT, x ARRAY<DOUBLE>").repartition(30)
    packed = whitening.pack(x.selectExpr("transform(x, c -> cast(floor(c * 1e15) as bigint)) AS x"))
    want = [sum(math.floor(v[k] * 1e15) for _, v in rows) for k in range(6)]
    assert whitening.column_sums(packed, 6) == want
    plain = whitening._summed(packed, 6, lambda block: block.astype(float).sum(axis=0), 6)
    assert np.allclose(plain, np.array(want, dtype=float), rtol=1e-12)
    source = (whitening.column_sums.__code__.co_names, whitening._summed.__code__.co_names)
    assert not any("explode" in name for names in source for name in names)
