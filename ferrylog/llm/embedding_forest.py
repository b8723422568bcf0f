"""Near-duplicate vectors by a forest of random-projection trees.

Each tree halves the vectors at the median of a random projection, again and again, until a leaf holds
``LEAF`` vectors or so. A vector within a margin of the cut goes to both sides (spill), so close vectors
are parted seldom, and in another way in each tree. All vectors of a leaf are compared by cosine in
double precision, scaled by powers of two so that no norm overflows; links found are exact, and a link is missed only if every tree parts its ends.

The upper levels are fitted on a bounded sample of the vectors (``SAMPLE``); every vector is put into
leaves. Leaves that are still too large are cut on by further distributed passes, as long as a cut
takes something away; what is left of them, a dense spot, is compared in tiles of bounded size.
Equal vectors are one vector with a count. A link is counted in the first leaf that its two ends share,
and a tile returns sums of counts and one edge per vector, so no list of pairs is ever made.

Vectors of each length have a forest of their own; vectors of different lengths do not link.

Results in special cases: a vector that is null, zero, empty, holds a null or a non-finite number links
with nothing and is its own component; a null vec_id gets no component and lends none; rows that share a vec_id are one node, and each row counts for itself; an
empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.components import components
from ferrylog.staging import stage

TREES = 8
LEAF = 512
LARGEST_LEAF = 4096
TILE = 1024
SAMPLE = 20_000
LEAST_SAMPLE = 32
SPILL = 0.5
CUTS = 40


def margin_of(cosine: float, dim: int) -> float:
    """Half width of the spill: ``SPILL`` deviations of the projected distance of the farthest link."""
    return SPILL * float(np.sqrt((2 - 2 * cosine) / dim))


def direction(tree: int, leaf: int, turn: int, dim: int) -> np.ndarray:
    """A random unit vector that every task makes alike."""
    axis = np.random.default_rng([11, tree, leaf, turn]).normal(size=dim)
    return axis / np.linalg.norm(axis)


@dataclass
class Forest:
    """Cuts of the upper levels: ``cuts[tree][leaf]``; the children of leaf n are 2 n and 2 n + 1."""

    dim: int
    margin: float
    cuts: list[dict[int, float]]

    @classmethod
    def fit(cls, sample: np.ndarray, rows: int, cosine: float) -> Forest:
        """``sample`` holds unit vectors, ``rows`` says how many vectors there are in all."""
        margin = margin_of(cosine, sample.shape[1])
        levels = max(0, int(np.ceil(np.log2(max(rows, 1) / LEAF))))
        cuts: list[dict[int, float]] = [{} for _ in range(TREES)]
        for tree in range(TREES):
            parts = {1: np.arange(len(sample))}
            for _ in range(levels):
                below = {}
                for leaf, at in parts.items():
                    if len(at) < LEAST_SAMPLE:
                        continue
                    p = sample[at] @ direction(tree, leaf, 0, sample.shape[1])
                    cuts[tree][leaf] = float(np.median(p))
                    below[2 * leaf], below[2 * leaf + 1] = at[p <= cuts[tree][leaf]], at[p > cuts[tree][leaf]]
                parts = below
        return cls(sample.shape[1], margin, cuts)

    def leaves(self, unit: np.ndarray, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of each place of each row in a tree."""
        rows, names, open_parts = [], [], [(1, np.arange(len(unit)))]
        while open_parts:
            leaf, at = open_parts.pop()
            if not len(at):
                continue
            cut = self.cuts[tree].get(leaf)
            if cut is None:
                rows.append(at)
                names.append(np.full(len(at), leaf, dtype=np.int64))
                continue
            p = unit[at] @ direction(tree, leaf, 0, self.dim)
            open_parts += [(2 * leaf, at[p <= cut + self.margin]), (2 * leaf + 1, at[p >= cut - self.margin])]
        return (np.concatenate(rows), np.concatenate(names)) if rows else (np.zeros(0, int), np.zeros(0, np.int64))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest component near one: exact, and no square overflows."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def stored_type(vectors: DataFrame) -> str:
    """Vectors of floats stay floats, half as long on disk; all that is reckoned with them is in doubles."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    return kind if kind == "array<float>" else "array<double>"


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct vectors that can link: ``(rep, n, embedding)`` with the smallest vec_id and the count."""
    value = F.col("embedding").cast(stored_type(vectors))
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(value, lambda x: x == 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), value.alias("embedding")
    )
    rows = rows.where((F.size("embedding") > 0) & ~F.coalesce(bad, F.lit(True)) & ~F.coalesce(zero, F.lit(True)))
    return rows.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")).select("rep", "n", "embedding")


def place(rows: DataFrame, forest: Forest) -> DataFrame:
    """``(tree, leaf, rep)``: every vector in all its leaves. Vectors stay where they are, and come to leaves when needed."""
    sent = rows.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                unit = unit_rows(matrix(part.column("embedding"), forest.dim))
                for tree in range(TREES):
                    at, leaf = forest.leaves(unit, tree)
                    took = part.column("rep").take(pa.array(at))
                    trees = pa.array(np.full(len(at), tree, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([trees, pa.array(leaf), took], names=["tree", "leaf", "rep"])

    return rows.select("rep", "embedding").mapInArrow(run, "tree int, leaf bigint, rep bigint")


def cut_on(rows: DataFrame, forest: Forest, distinct: DataFrame) -> DataFrame:
    """Cut leaves that hold more than ``LARGEST_LEAF`` vectors, until none is left that a cut makes smaller."""
    dim, margin = forest.dim, forest.margin
    vectors = distinct.select("rep", "embedding")

    def groups(batch: pa.RecordBatch, turn: int):
        names = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "leaf")], axis=1)
        unit = unit_rows(matrix(batch.column("embedding"), dim))
        for tree, leaf in np.unique(names, axis=0):
            at = np.flatnonzero((names == (tree, leaf)).all(axis=1))
            yield int(tree), int(leaf), at, unit[at] @ direction(int(tree), int(leaf), turn + 1, dim)

    for turn in range(CUTS):
        big = rows.groupBy("tree", "leaf").count().where(F.col("count") > LARGEST_LEAF).select("tree", "leaf")
        big = stage(big, "big-leaves")
        if big.isEmpty():
            break

        def project(batches: Iterator[pa.RecordBatch], turn: int = turn) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for tree, leaf, at, p in groups(batch, turn):
                    cols = [np.full(len(at), tree, np.int32), np.full(len(at), leaf, np.int64), p]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["tree", "leaf", "p"])

        found = rows.join(big, ["tree", "leaf"]).join(vectors, "rep").mapInArrow(project, "tree int, leaf bigint, p double")
        cuts = found.groupBy("tree", "leaf").agg(F.percentile_approx("p", [0.2, 0.5, 0.8], 1000).alias("q"))
        cuts = cuts.where((F.col("q")[2] > F.col("q")[1] + margin) | (F.col("q")[0] < F.col("q")[1] - margin))
        cuts = stage(cuts.select("tree", "leaf", F.col("q")[1].alias("cut")), "cuts")
        if cuts.isEmpty():
            break

        def split(batches: Iterator[pa.RecordBatch], turn: int = turn) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cut = batch.column("cut").to_numpy(zero_copy_only=False)
                for _, leaf, at, p in groups(batch, turn):
                    for child, side in ((2 * leaf, p <= cut[at] + margin), (2 * leaf + 1, p >= cut[at] - margin)):
                        took = batch.take(pa.array(at[side]))
                        cols = [took.column("tree"), pa.array(np.full(took.num_rows, child, np.int64))]
                        yield pa.RecordBatch.from_arrays([*cols, took.column("rep")], names=["tree", "leaf", "rep"])

        parted = rows.join(cuts, ["tree", "leaf"]).join(vectors, "rep").mapInArrow(split, rows.schema)
        rows = stage(rows.join(cuts, ["tree", "leaf"], "left_anti").select(*rows.columns).union(parted), "leaves")
    return rows


def tiles(rows: DataFrame, distinct: DataFrame) -> DataFrame:
    """Rows of each tile, with the codes of all leaves of a vector: two pieces of a leaf, or one with itself.

    Here vectors meet their leaves, on the way into the one shuffle that brings a tile together.
    """
    code = F.col("tree").cast("bigint") * (1 << 56) + F.col("leaf")
    coded = rows.select(code.alias("code"), "rep")
    places = coded.groupBy("rep").agg(F.sort_array(F.collect_set("code")).alias("codes"))  # a few dozen numbers
    leaves = coded.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("parts"))
    dealt = (
        coded.join(stage(leaves, "leaves"), "code")
        .join(places.join(distinct.select("rep", "n", "embedding"), "rep"), "rep")
        .withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )
    return dealt.select(
        "code", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "rep", "n", "codes", "embedding"
    )


def compare(table: pa.Table, cosine: float) -> pa.Table:
    """Links within a tile: ``(rep, links, near)``, the links counted here and a vector to be united with."""
    columns = {c: table.column(c).combine_chunks() for c in ("rep", "n", "codes", "embedding", "mine", "code", "i", "j")}
    rep, n, mine = (columns[c].to_numpy(zero_copy_only=False) for c in ("rep", "n", "mine"))
    code, i, j = (columns[c][0].as_py() for c in ("code", "i", "j"))
    vectors = scaled(matrix(columns["embedding"], len(columns["embedding"][0])))
    norms = np.linalg.norm(vectors, axis=1)
    near = vectors @ vectors.T / np.outer(norms, norms) >= cosine
    np.fill_diagonal(near, False)
    if i != j:
        near &= mine[:, None] != mine[None, :]
    codes = columns["codes"].to_pylist()
    width = max(map(len, codes))
    grid = np.array([c + [-1] * (width - len(c)) for c in codes], dtype=np.int64)
    links = np.zeros(len(rep), dtype=np.int64)
    for k in np.flatnonzero(near.any(axis=1)):
        others = np.flatnonzero(near[k])
        # shared before this leaf: the smallest code in common is another one
        before = np.array([c for c in codes[k] if c < code], dtype=np.int64)
        first = ~np.isin(grid[others], before).any(axis=1)
        links[k] = n[others[first]].sum()
    label = np.arange(len(rep))
    while True:
        below = np.minimum(label, np.where(near, label[None, :], len(rep)).min(axis=1, initial=len(rep)))
        if (below == label).all():
            break
        label = below
    some = np.flatnonzero((links > 0) | (label < np.arange(len(rep))))
    cols = [pa.array(rep[some]), pa.array(links[some]), pa.array(rep[label[some]])]
    return pa.Table.from_arrays(cols, names=["rep", "links", "near"])


def _links(distinct: DataFrame, dim: int, rows: int, cosine: float) -> DataFrame:
    """``(rep, links, near)`` of the distinct vectors of one length."""
    share = min(1.0, SAMPLE / rows)
    drawn = distinct.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < share * (1 << 20)).limit(2 * SAMPLE)
    sample = np.array([r[0] for r in drawn.select("embedding").collect()], dtype=np.float64).reshape(-1, dim)
    forest = Forest.fit(unit_rows(sample), rows, cosine)
    leaves = cut_on(stage(place(distinct, forest), "leaves"), forest, distinct)
    run = lambda table: compare(table, cosine)
    found = tiles(leaves, distinct).groupBy("code", "i", "j").applyInArrow(run, "rep bigint, links bigint, near bigint")
    return stage(found, "links")


def link_vectors(vectors: DataFrame, *, cosine: float = 0.95) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, a row per row of ``vectors(vec_id, embedding)``."""
    spark = vectors.sparkSession
    distinct = stage(usable(vectors), "vectors")
    # a single vector of its length has no link but those of its copies
    lengths = distinct.groupBy(F.size("embedding").alias("d")).count().where("count > 1").orderBy("d").collect()
    given = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(stored_type(vectors)).alias("embedding")
    )
    found = spark.createDataFrame([], "rep bigint, links bigint, near bigint, d int")
    for dim, rows in lengths:
        found = found.union(_links(distinct.where(F.size("embedding") == dim), dim, rows, cosine).withColumn("d", F.lit(dim)))
    edges = found.where("rep <> near").select(F.col("rep").alias("a"), F.col("near").alias("b"))
    copies = given.where("vec_id IS NOT NULL").join(distinct, "embedding").select("vec_id", "rep", "n", F.lit(1).alias("one"))
    copies = stage(copies, "copies")
    again = copies.groupBy("vec_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    edges = edges.union(copies.join(again, "vec_id").select("vec_id", "rep"))
    roots = stage(components(edges), "roots")
    counts = found.groupBy("rep", "d").agg(F.sum("links").alias("links"))
    facts = (
        distinct.withColumn("d", F.size("embedding"))
        .join(counts, ["rep", "d"], "left")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select("embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "rep").alias("class"))
    )
    named = F.col("vec_id").isNotNull()
    return given.join(facts, "embedding", "left").select(
        "vec_id",
        F.when(named, F.coalesce("links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
        F.when(named, F.coalesce("class", "vec_id")).alias("component_id"),
        (named & F.coalesce(F.coalesce("class", "vec_id") == F.col("vec_id"), F.lit(False))).alias("kept"),
    )
