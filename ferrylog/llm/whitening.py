"""Whitening of vectors by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

The covariance is never formed. It acts on a block of directions by a distributed product: each task
centres its vectors, multiplies them with the block and sums up. There are at most four tasks a core, and a
product gives the driver ``dimension x block`` numbers of each, however many vectors there are.

A subspace grows around the wanted directions. Rayleigh-Ritz in it gives the current directions; the ones
whose residual has reached double precision are locked, from the first on. For the others the
correction equation, projected away from what is locked and from the current directions, is solved by
MINRES, all columns in step, so that a step of all of them is one pass over the vectors. A subspace that
has become wide is begun again from its best directions.

The fit is over each distinct vector of whole numbers once. These are packed into blocks of bytes in
the shared folder, so that a pass reads little and a lost executor costs a part of a pass only.

Results in special cases: a vector that is null or empty, or holds a null, a non-finite or a too large component
(2^62 after scaling), gives no row; vectors of each length are fitted apart; a null vec_id stays null and
repeated rows are each projected; directions of no variance are no components, so a table of one distinct
vector gives no row, as does an empty one. ``deviation`` is null where it does not fit into 64 bits;
``deviation_exact`` holds it up to 38 digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.vectors import rows_by_length, whole
from ferrylog.staging import stage

COMPONENTS = 4
GUARDS = 4
WIDEST = 40
INNER = 12
ROUNDS = 60
EPS = float(np.finfo(float).eps)
BLOCK_BYTES = 4 << 20


def pack(distinct: DataFrame) -> DataFrame:
    """``(dim, n, kind, block)``: up to four megabytes of vectors of one length in each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, (_, x) in rows_by_length(batch.column("x")).items():
                kind = next(k for k in ("<i2", "<i4", "<i8") if not x.size or np.abs(x).max() <= np.iinfo(k).max)
                step = max(1, BLOCK_BYTES // (8 * dim))
                parts = [x[i : i + step] for i in range(0, len(x), step)]
                cols = [
                    pa.array([dim] * len(parts), pa.int32()),
                    pa.array([len(p) for p in parts], pa.int64()),
                    pa.array([kind] * len(parts), pa.string()),
                    pa.array([p.astype(kind).tobytes() for p in parts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["dim", "n", "kind", "block"])

    return distinct.mapInArrow(run, "dim int, n bigint, kind string, block binary")


def matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    """The packed vectors again, a block at a time."""
    for batch in batches:
        for kind, block in zip(batch.column("kind").to_pylist(), batch.column("block"), strict=True):
            yield np.frombuffer(block.as_buffer(), dtype=kind).reshape(-1, dim)


def _few_tasks(packed: DataFrame) -> DataFrame:
    """All blocks in at most four tasks a core, so the driver gets as many sums of a pass, however many files there are."""
    return packed.select("kind", "block").coalesce(4 * packed.sparkSession.sparkContext.defaultParallelism)


def _summed(packed: DataFrame, dim: int, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``part`` over all blocks, an array of ``size`` doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for x in matrices(batches, dim):
            total += part(x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["v"])

    found = np.zeros(size)
    for (v,) in _few_tasks(packed).mapInArrow(run, "v array<double>").collect():
        found += v
    return found


def column_sums(packed: DataFrame, dim: int) -> list[int]:
    """Exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dim
        for x in matrices(batches, dim):
            # high and low halves, so that no sum of a block leaves 64 bits
            x = x.astype(np.int64)
            high, low = (x >> 31).sum(axis=0).tolist(), (x & 0x7FFFFFFF).sum(axis=0).tolist()
            total = [t + (h << 31) + l for t, h, l in zip(total, high, low, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([list(map(str, total))], pa.list_(pa.string()))], names=["v"])

    found = _few_tasks(packed).mapInArrow(run, "v array<string>").collect()
    return [sum(map(int, each)) for each in zip(*[v for (v,) in found], strict=True)]


def orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to ``against``; two passes, so that it is so to rounding."""
    kept: list[np.ndarray] = []
    for column in block.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        column = column / size
        for _ in range(3):
            for basis in against:
                column = column - basis @ (basis.T @ column)
            for other in kept:
                column = column - other * (other @ column)
            size = np.linalg.norm(column)
            if size < 1e-10:
                break
            column = column / size
        else:
            kept.append(column)
    return np.array(kept).T.reshape(len(block), len(kept))


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, tol: float, most: int) -> np.ndarray:
    """MINRES for each column of ``right`` at once, until all have lost all but ``tol`` of their residual."""

    def divide(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros_like(a), where=b > 0)

    first = np.linalg.norm(right, axis=0)
    x, before, now = np.zeros_like(right), np.zeros_like(right), divide(right, np.broadcast_to(first, right.shape))
    w_old, w = np.zeros_like(right), np.zeros_like(right)
    beta, eta = np.zeros_like(first), first.copy()
    c_old, c, s_old, s = np.ones_like(first), np.ones_like(first), np.zeros_like(first), np.zeros_like(first)
    for _ in range(most):
        p = apply(now)
        alpha = (now * p).sum(axis=0)
        p = p - alpha * now - beta * before
        after = np.linalg.norm(p, axis=0)
        rho_0 = c * alpha - c_old * s * beta
        rho_1, rho_2, rho_3 = np.hypot(rho_0, after), s * alpha + c_old * c * beta, s_old * beta
        c_old, c, s_old, s = c, divide(rho_0, rho_1), s, divide(after, rho_1)
        w_old, w = w, divide(now - rho_3 * w_old - rho_2 * w, np.broadcast_to(rho_1, now.shape))
        x = x + c * eta * w
        eta = -s * eta
        before, now, beta = now, divide(p, np.broadcast_to(after, p.shape)), after
        if (np.abs(eta) <= tol * first).all():
            break
    return x


def leading(apply: Callable[[np.ndarray], np.ndarray], dim: int, count: int, trace: float) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of the symmetric ``apply``, the largest first, without those of no size."""
    count = min(count, dim)
    tol, none = 8 * EPS * np.sqrt(dim), dim * EPS * trace
    draw = np.random.default_rng(17).normal
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    basis = orthonormal(draw(size=(dim, min(dim, count + GUARDS))))
    image = apply(basis)
    least, stuck = np.inf, 0
    for turn in range(ROUNDS):
        theta, s = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        u, r = basis @ s, image @ s - (basis @ s) * theta
        sizes = np.linalg.norm(r, axis=0)
        highest = max(np.abs(theta).max(initial=0.0), values.max(initial=0.0))
        whole_space = locked.shape[1] + basis.shape[1] == dim
        want = min(count - len(values), len(theta))
        # rounding stops the residuals somewhere near the tolerance: three rounds without gain end it
        worst = sizes[:want].max(initial=0.0)
        stuck, least = (stuck + 1, least) if worst > least / 2 else (0, worst)
        done = 0
        while done < want and (whole_space or sizes[done] <= tol * highest or stuck >= 3 and sizes[done] <= 1e4 * tol * highest):
            done += 1
        locked, values = np.hstack([locked, u[:, :done]]), np.append(values, theta[:done])
        if len(values) == count or whole_space or (len(values) and values[-1] <= none):
            break
        if done:
            least, stuck = np.inf, 0
        keep = slice(done, None if len(theta) - done <= WIDEST else done + count + GUARDS)
        basis, image, want = u[:, keep], (image @ s)[:, keep], want - done
        aim, shift, rest = u[:, done : done + want], theta[done : done + want], r[:, done : done + want]
        away = np.hstack([locked, aim])

        def project(block: np.ndarray, away: np.ndarray = away) -> np.ndarray:
            return block - away @ (away.T @ block)

        def correction(block: np.ndarray, project=project, shift: np.ndarray = shift) -> np.ndarray:
            block = project(block)
            return project(apply(block) - block * shift)

        more = minres(correction, -project(rest), 0.5 ** (turn + 1), INNER)
        more = orthonormal(more, locked, basis)
        if not more.shape[1]:
            more = orthonormal(draw(size=(dim, 1)), locked, basis)
        basis, image = np.hstack([basis, more]), np.hstack([image, apply(more)])
    good = values > none
    return values[good], locked[:, good]


@dataclass
class Whitening:
    """What one length of vectors needs: moments, directions and their quality."""

    dim: int
    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(packed: DataFrame, dim: int, count: int = COMPONENTS) -> Whitening:
    """``packed`` holds the distinct vectors of length ``dim``."""
    n = packed.agg(F.sum("n")).first()[0]
    sums = column_sums(packed, dim)
    mean = np.array([s / n for s in sums])

    def product(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ block)

        return _summed(packed, dim, part, block.size).reshape(block.shape) / n

    trace = float(_summed(packed, dim, lambda x: ((x - mean) ** 2).sum(axis=0), dim).sum() / n)
    values, directions = leading(product, dim, count, trace) if trace > 0 else (np.zeros(0), np.zeros((dim, 0)))
    k, scaled = len(values), directions / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ scaled
        return np.vstack([y.sum(axis=0), y.T @ y])

    error = 0.0
    if k:
        found = _summed(packed, dim, moments, (k + 1) * k).reshape(k + 1, k) / n
        error = float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(k)).max())
    return Whitening(dim, n, sums, values, directions, values / trace if k else values, error)


def project(rows: DataFrame, fits: dict[int, Whitening]) -> DataFrame:
    """A row per row of ``rows(vec_id, x)`` and component of its length."""
    sent = rows.sparkSession.sparkContext.broadcast(fits)  # a few vectors for each length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, (at, x) in rows_by_length(batch.column("x")).items():
                one = sent.value.get(dim)
                if one is not None and len(one.values):
                    for i in range(0, len(at), 2000):
                        yield _projected(one, batch.column("vec_id").take(pa.array(at[i : i + 2000])), x[i : i + 2000])

    def _projected(one: Whitening, ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        largest = max(int(np.abs(x).max()), 1) * one.n + max(map(abs, one.sums))
        kind = np.int64 if largest * largest * one.dim < 1 << 62 else object
        moved = x.astype(kind) * one.n - np.array(one.sums, dtype=kind)
        exact = (moved * moved).sum(axis=1).tolist()
        white = (moved.astype(float) / one.n) @ (one.directions / np.sqrt(one.values))
        k = len(one.values)
        each = pa.array(np.repeat(np.arange(len(x)), k))
        cols = [
            ids.take(each),
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
            pa.array(np.full(len(x) * k, one.n)),
            pa.array([v if v < 1 << 63 else None for v in exact], pa.int64()).take(each),
            pa.array(white.ravel()),
            pa.array(np.tile(one.explained, len(x))),
            pa.array(np.full(len(x) * k, one.identity_error)),
            pa.array([str(v) for v in exact], pa.string()).take(each),
        ]
        return pa.RecordBatch.from_arrays(cols, names=names)

    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "digits"]
    kinds = ["bigint", "int", "bigint", "bigint", "double", "double", "double", "string"]
    out = rows.mapInArrow(run, ", ".join(map(" ".join, zip(names, kinds, strict=True))))
    return out.select(*names[:-1], F.expr("try_cast(digits AS decimal(38,0))").alias("deviation_exact"))


def whiten(vectors: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact)`` of ``vectors(vec_id, embedding)``."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole(F.col("embedding")).alias("x")).where("x IS NOT NULL")
    packed = stage(pack(rows.select("x").distinct()), "packed-vectors")
    dims = [r.dim for r in packed.select("dim").distinct().orderBy("dim").collect()]
    return project(rows, {dim: fit(packed.where(F.col("dim") == dim), dim, count) for dim in dims})
