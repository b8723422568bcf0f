"""Jaccard join of word n-gram sets: size-banded tiles, bitmap signatures, exact intersection.

Documents become sorted arrays of distinct shingle hashes; equal arrays are one set, represented by
the smallest doc_id. Two sets can only link when their sizes are close, so sizes are banded. Within a
band two linking sets differ in at most ``k`` shingles, a number that follows from the threshold and
the band's sizes. Shingles are dealt to more than ``k`` blocks by hash, so linking sets agree in a whole
block: sets that agree in a block form a *tile*, and no link lies outside the tiles. A block holds a few
shingles from anywhere in the document, so a passage or line that many documents share does not bring
them together, unlike the prefixes of a sorted array.

Blocks without a shingle say nothing. A set with too many of them deals its shingles anew under the
next seed as well; of two linking sets that agree in empty blocks only, both do, so the join is exact.

In a tile members are first compared with one leader each, in a few rounds, and sets that have come
into the same component are not compared any more: large groups of near copies cost a comparison per
member. What is still open after these rounds is compared block by block in tiles of bounded size. In
either case the parity bitmaps of two sets, which are short, meet first. They bound the overlap from above:
|A & B| <= (|A| + |B| - bits that differ) / 2. Only the sets of pairs that pass are shuffled, and are checked
by intersecting the sorted arrays. An array is longer than its text, so arrays are never kept: they are made
from the texts of those pairs again, and only bitmaps are staged.

``link_counts`` gives the number of links of each row too. It compares the members of each component once
more, all with all, so its work grows with the square of a component's distinct sets.

Results in special cases: without words (also null or empty texts) a document has an empty set and
links with nothing; a row without doc_id gets its size, no component and no link; rows that share a
doc_id are one node with the links of all its texts; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrylog.llm.components import components
from ferrylog.llm.words import Words, mix, shingles, slices
from ferrylog.session import bounded_batches
from ferrylog.staging import scratch, small, stage

MAX_SEEDS = 32
LEADER_ROUNDS = 3
OPEN_ROWS, TILE_ROWS = 256, 1024
LINK_SETS, LINK_ITEMS = 512, 1 << 20
MIN_BITS, MAX_BITS = 64, 1 << 14


@dataclass(frozen=True)
class Rule:
    """Sets of ``words``-word shingles link when den * |A & B| >= num * |A | B|."""

    words: int = 5
    num: int = 80
    den: int = 100

    @cached_property
    def bands(self) -> np.ndarray:
        """Smallest size of each band; a band is at least as wide as two linking sizes can differ."""
        low = [1]
        while low[-1] < 1 << 40:
            low.append(max(low[-1] + 1, low[-1] * 3 // 2, -(-low[-1] * self.den // self.num)))
        return np.array(low, dtype=np.int64)

    def spaces(self, n: int) -> list[int]:
        """The bands in which a set of ``n`` shingles is compared: its own, and the one below if near enough."""
        band = int(np.searchsorted(self.bands, n, side="right")) - 1
        below = band > 0 and self.den * (int(self.bands[band]) - 1) >= self.num * n
        return [band, band - 1] if below else [band]

    def differences(self, space: int) -> int:
        """How many shingles two linking sets of a space can differ in."""
        top = int(self.bands[space + 1]) - 1
        return (self.den - self.num) * (top + top * self.den // self.num) // (self.den + self.num)

    @lru_cache(maxsize=256)  # noqa: B019  one rule to a worker
    def blocks(self, space: int) -> int:
        """How many blocks a space deals shingles to: so many that its smallest sets fill more than ``differences``.

        ``low`` shingles leave about ``n * exp(-low / n)`` of ``n`` blocks empty; a deviation is added.
        """
        low, k = int(self.bands[space]), self.differences(space)
        for n in range(k + 1, 2 * k + 2):
            empty = n * math.exp(-low / n)
            if n - empty - math.sqrt(empty) > k:
                return n
        return 2 * k + 1

    def links(self, common: int, a: int, b: int) -> bool:
        return self.den * common >= self.num * (a + b - common)


def sets_of(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    for _, _, raw, offsets in slices(texts):
        yield from shingles(Words(raw, offsets), words)


def set_keys(values: np.ndarray) -> tuple[int, int]:
    """128 bits that name the set."""
    a, b = mix(values), mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return int(a.sum(dtype=np.uint64).view(np.int64)), int(b.sum(dtype=np.uint64).view(np.int64))


def block_keys(values: np.ndarray, rule: Rule) -> np.ndarray:
    """The tiles of a set: a hash of each block's place and content."""
    keys = []
    with np.errstate(over="ignore"):
        for space in rule.spaces(len(values)):
            k = rule.differences(space)
            if not k:  # only equal sets link here
                continue
            blocks = rule.blocks(space)
            for seed in range(MAX_SEEDS + 1):
                tag = mix(np.array([(space << 16) + seed + 1], dtype=np.uint64))[0]
                dealt = mix(values ^ tag)
                place = (dealt >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
                order = np.argsort(place, kind="stable")
                place = place[order]
                at = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
                content = np.add.reduceat(mix(dealt + tag)[order], at)
                keys.append(mix(content + mix(place[at] + tag)))
                if blocks - len(at) < blocks - k:
                    break
            else:  # as good as never: agree in the empty blocks too
                empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), place[at])
                keys.append(mix(mix(empty + tag)))
    return np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)


def packed(keys: np.ndarray, names: np.ndarray, buckets: int) -> pa.RecordBatch:
    """``(bucket, keys, names)`` of postings: the upper half of a key gives its bucket, the lower half is kept."""
    bucket = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")  # names stay in runs, which compress
    bucket = bucket[order].astype(np.int32)
    at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    offsets = pa.array(np.append(at, len(bucket)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in (keys.astype(np.uint32).view(np.int32), names)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[at]), *lists], names=["bucket", "keys", "names"])


def parity_bits(values: np.ndarray) -> bytes:
    """A bit per hash value, flipped by every shingle; the length follows the size of the set."""
    bits = MIN_BITS
    while bits < MAX_BITS and bits < 2 * len(values):
        bits *= 2
    seen = np.bincount((mix(values) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(seen.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmap rows folded to ``size`` bytes; parity bitmaps of a power of two fold by exclusive or."""
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def overlap_bound(n_a, n_b, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Upper bound of the intersection from sizes and bitmaps."""
    size = min(a.shape[-1], b.shape[-1])
    apart = np.bitwise_count(folded(a, size) ^ folded(b, size)).sum(axis=-1, dtype=np.int64)
    return np.minimum(np.minimum(n_a, n_b), (n_a + n_b - apart) // 2)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def measured(docs: DataFrame, rule: Rule, *, bits: bool = False, items: bool = False) -> DataFrame:
    """The sets of ``docs(doc_id, text)``: ``(rep, n, k1, k2)``, and their bitmaps and sorted arrays as asked for; no empty sets."""
    size = rule.words
    more = ["bits binary"] * bits + ["items array<bigint>"] * items

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, held = batch.column("doc_id").to_pylist(), [], 0
            for i, values in enumerate(sets_of(batch.column("text"), size)):
                if len(values):
                    found.append((ids[i], len(values), *set_keys(values), parity_bits(values) if bits else None, values.view(np.int64)))
                    held += len(values)
                if held > 1 << 20:
                    yield _batch(found)
                    found, held = [], 0
            if found:
                yield _batch(found)

    def _batch(found):
        *numbers, maps, arrays = zip(*found, strict=True)
        cols = [pa.array(x, pa.int64()) for x in numbers]
        if bits:
            cols.append(pa.array(maps, pa.binary()))
        if items:
            offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
            cols.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays))))
        return pa.RecordBatch.from_arrays(cols, names=["rep", "n", "k1", "k2", *(c.split()[0] for c in more)])

    return docs.mapInArrow(measure, ", ".join(["rep bigint, n bigint, k1 bigint, k2 bigint", *more]))


class NgramJoin:
    """The stages of one join over ``docs(doc_id, text)``."""

    def __init__(self, docs: DataFrame, rule: Rule):
        bounded_batches(docs.sparkSession)
        self.docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        self.rule = rule

    def facts(self) -> DataFrame:
        """Size and name of each row's set: ``(doc_id, n, k1, k2)``."""
        size = self.rule.words

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(len(v), *set_keys(v)) for v in sets_of(batch.column("text"), size)]
                n, k1, k2 = zip(*found, strict=True) if found else ((), (), ())
                cols = [pa.array(x, type=pa.int64()) for x in (n, k1, k2)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=["doc_id", "n", "k1", "k2"])

        return self.docs.mapInArrow(measure, "doc_id bigint, n bigint, k1 bigint, k2 bigint")

    def postings(self) -> DataFrame:
        """Every tile of every set: ``(bucket, key, k1)``.

        They are by far the most rows, so they are shuffled as arrays, one for each bucket of keys in some documents:
        the bucket says where a key goes, and the rest of the key needs 32 bits. Two tiles that get the same
        bucket and key are one, whose members are compared like others.
        """
        rule = self.rule
        buckets = int(self.docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, names, rows = [], [], 0
                for values in sets_of(batch.column("text"), rule.words):
                    if len(values):
                        found = block_keys(values, rule)
                        keys.append(found)
                        names.append(np.full(len(found), set_keys(values)[0], dtype=np.int64))
                        rows += len(found)
                    if rows > 200_000:
                        yield packed(np.concatenate(keys), np.concatenate(names), buckets)
                        keys, names, rows = [], [], 0
                if rows:
                    yield packed(np.concatenate(keys), np.concatenate(names), buckets)

        dealt = self.docs.where("doc_id IS NOT NULL").mapInArrow(deal, "bucket int, keys array<int>, names array<bigint>")
        dealt = dealt.repartitionById(buckets, "bucket").select("bucket", "names", F.posexplode("keys").alias("at", "key"))
        return dealt.select("bucket", "key", F.col("names")[F.col("at")].alias("k1"))

    def sets(self, wanted: DataFrame) -> DataFrame:
        """Bitmaps of the wanted reps: ``(rep, n, k1, k2, bits)``."""
        # a short list, so that the texts need not be shuffled to meet it
        wanted = small(stage(wanted.withColumnRenamed("rep", "doc_id"), "wanted"))
        return measured(self.docs.join(wanted, "doc_id", "left_semi"), self.rule, bits=True)

    def allowed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """``(a, b, near)`` of candidate pairs ``(a, b)``: whether their bitmaps allow a link; no array is moved."""
        rule = self.rule

        def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n_a, n_b = (batch.column(c).to_pylist() for c in ("n_a", "n_b"))
                bits = [[np.frombuffer(x, dtype=np.uint8) for x in batch.column(c).to_pylist()] for c in ("bits_a", "bits_b")]
                near = [rule.links(int(overlap_bound(m, n, x, y)), m, n) for m, n, x, y in zip(n_a, n_b, *bits, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(near, pa.bool_())], names=["a", "b", "near"]
                )

        one, two = (sets.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab")
        both = two.join(small(stage(pairs, "pairs")), "b").join(one, "a").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
        return both.mapInArrow(bound, "a bigint, b bigint, near boolean").groupBy("a", "b").agg(F.max("near").alias("near"))

    def verified(self, pairs: DataFrame, docs: DataFrame) -> DataFrame:
        """``(a, b, linked)`` of candidate pairs ``(a, b)`` of ``docs(doc_id, text)``, whose sets are made for it."""
        rule = self.rule

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                items = [_lists(batch.column(c)) for c in ("items_a", "items_b")]
                linked = []
                for i in range(batch.num_rows):
                    a, b = items[0](i), items[1](i)
                    bound = min(len(a), len(b))  # sets of one doc_id may differ in size
                    linked.append(rule.links(bound, len(a), len(b)) and rule.links(common(a, b), len(a), len(b)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
                )

        def _lists(column):
            offsets = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False)
            return lambda i: values[offsets[i] : offsets[i + 1]].view(np.uint64)

        # texts are long and pairs short: short lists go to the texts, so that only the sets of what is in a
        # pair are made and shuffled, once as an end that others meet and once for each pair as the end they meet
        pairs = stage(pairs, "pairs")

        def ends(c: str) -> DataFrame:
            some = small(stage(pairs.select(F.col(c).alias("doc_id")).distinct(), "ends"))
            of = measured(docs.join(some, "doc_id", "left_semi"), rule, items=True)
            return of.select(F.col("rep").alias(c), F.col("items").alias(f"items_{c}"))

        both = ends("b").join(small(pairs), "b").join(ends("a"), "a").select("a", "b", "items_a", "items_b")
        found = both.mapInArrow(verify, "a bigint, b bigint, linked boolean")
        return found.groupBy("a", "b").agg(F.max("linked").alias("linked"))

    def open_pairs(self, live: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs of different components in the same tile whose bitmaps allow a link: ``(a, b)``.

        In each tile the largest component is left as it is and all other members are compared with
        everybody; both sides are cut into pieces, so a task never sees more than two pieces.
        """
        rule = self.rule
        parts = live.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
        tiles = parts.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("c").alias("m"))
        tiles = tiles.join(parts.select("key", F.col("label").alias("main"), F.col("c").alias("most")), ["key", "main"])
        pieces = lambda rows, size: F.ceil(rows / size).cast("int")
        tiles = stage(tiles.select(
            "key", "main", pieces(F.col("m"), TILE_ROWS).alias("mc"), pieces(F.col("m") - F.col("most"), OPEN_ROWS).alias("uc")
        ), "tiles")
        rows = live.join(tiles, "key").join(sets.select("rep", "n", "bits"), "rep")
        deal = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        asks = rows.where("label <> main").select(
            "key", deal(F.col("uc")).alias("u"), every(F.col("mc")).alias("m"), F.lit(True).alias("asks"), "rep", "label", "n", "bits"
        )
        told = rows.select(
            "key", every(F.col("uc")).alias("u"), deal(F.col("mc")).alias("m"), F.lit(False).alias("asks"), "rep", "label", "n", "bits"
        )

        def compare(table: pa.Table) -> pa.Table:
            asks = table.column("asks").to_numpy()
            rep, label, n = (table.column(c).to_numpy() for c in ("rep", "label", "n"))
            bits = [np.frombuffer(x, dtype=np.uint8) for x in table.column("bits").to_pylist()]
            size = min(map(len, bits))
            bits = np.stack([folded(b, size) for b in bits])
            others = np.flatnonzero(~asks)
            a, b = [], []
            for i in np.flatnonzero(asks):
                js = others[label[others] != label[i]]
                bound = overlap_bound(n[i], n[js], bits[i], bits[js])
                js = js[rule.den * bound >= rule.num * (n[i] + n[js] - bound)]
                a.append(np.minimum(rep[i], rep[js]))
                b.append(np.maximum(rep[i], rep[js]))
            cols = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (a, b)]
            return pa.Table.from_arrays([pa.array(c) for c in cols], names=["a", "b"])

        return asks.union(told).groupBy("key", "u", "m").applyInArrow(compare, "a bigint, b bigint").distinct()

    def classes(self) -> DataFrame:
        """``(doc_id, n_shingles, component_id)``, a row per row of the documents."""
        return self.found()[0].select("doc_id", F.col("n").alias("n_shingles"), "component_id")

    def found(self) -> tuple[DataFrame, DataFrame]:
        """``(doc_id, n, k1, k2, component_id)`` of each row, and the sets that share a tile with another one."""
        facts = stage(self.facts(), "facts")
        reps = facts.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "k1", "k2").agg(
            F.min("doc_id").alias("rep"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("c")
        )
        reps = stage(reps.select("n", "k1", "k2", "rep", "c"), "reps")
        # one shuffle of the postings both finds the tiles of several sets and keeps their members
        tile = Window.partitionBy("bucket", "key")
        met = (F.min("k1").over(tile) < F.max("k1").over(tile)).alias("met")
        met = self.postings().select("bucket", "key", "k1", met).where("met").select("bucket", "key", "k1").distinct()
        key = F.shiftleft(F.col("bucket").cast("bigint"), 32) + F.col("key")
        members = met.select(key.alias("key"), "k1").join(reps.select("k1", "rep"), "k1").select("key", "rep")
        members = stage(members, "members")
        sets = stage(self.sets(members.select("rep").distinct()), "sets")

        named = facts.join(reps.drop("c"), ["n", "k1", "k2"]).select("doc_id", "rep")
        twice = named.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
        edges = stage(
            named.join(twice, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct(), "edges"
        )
        failed = edges.where("a IS NULL")
        roots = stage(components(edges), "roots")

        def labelled() -> DataFrame:
            """The members of tiles that still have several components."""
            rows = members.join(roots, F.col("rep") == F.col("node"), "left")
            rows = rows.select("key", "rep", F.coalesce("component", "rep").alias("label"))
            mixed = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("rep").alias("leader"))
            return stage(rows.join(mixed.where("lo < hi").select("key", "leader"), "key"), "live")

        for turn in range(LEADER_ROUNDS + 1):
            live = labelled()
            if live.isEmpty():
                break
            if turn < LEADER_ROUNDS:
                # a tile's smallest member against all others that are not in its component
                lead = live.where("rep = leader").select("key", F.col("label").alias("top"))
                pairs = live.join(lead, "key").where("rep <> leader AND label <> top")
                pairs = pairs.groupBy(F.col("leader").alias("a"), F.col("rep").alias("b")).agg(F.count(F.lit(1)).alias("tiles"))
                if not turn:  # first with the leader met in most tiles only
                    pairs = pairs.groupBy("b").agg(F.max_by("a", F.struct("tiles", -F.col("a"))).alias("a"))
            else:
                pairs = self.open_pairs(live, sets)
            pairs = pairs.select("a", "b").join(failed, ["a", "b"], "left_anti")
            if turn < LEADER_ROUNDS:  # open pairs have passed this already
                bounded = stage(self.allowed(pairs, sets), "bounded")
                failed = failed.union(bounded.where("NOT near").select("a", "b"))
                pairs = bounded.where("near").select("a", "b")
            result = stage(self.verified(pairs, self.docs), "verified")
            failed = stage(failed.union(result.where("NOT linked").select("a", "b")), "failed")
            linked = result.where("linked").select("a", "b")
            roots = stage(components(linked.union(roots.select("node", "component"))), "roots")
            if turn:  # these leaders have met everybody; the next ones take over
                members = live.where("rep > leader").select("key", "rep")
        root = lambda c: F.coalesce(F.col("component"), F.col(c))
        reps = reps.join(roots, F.col("rep") == F.col("node"), "left").select("n", "k1", "k2", root("rep").alias("class"))
        out = facts.join(reps, ["n", "k1", "k2"], "left")
        label = F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id"))
        return out.select("doc_id", "n", "k1", "k2", label.alias("component_id")), sets


    def linked(self) -> DataFrame:
        """``(doc_id, n_shingles, component_id, n_links)``, a row per row of the documents.

        A link lies within a component, so all members of each component are compared, in pieces of
        bounded size that each pair meets in once. Equal sets count by their rows with a doc_id.
        """
        rule = self.rule
        facts, sets = self.found()
        named = facts.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "k1", "k2")
        groups = named.agg(F.min("component_id").alias("label"), F.count(F.lit(1)).alias("c"))
        known = sets.select("n", "k1", "k2").distinct()
        groups = stage(groups.join(known.withColumn("met", F.lit(True)), ["n", "k1", "k2"], "left"), "groups")
        sizes = groups.where("met").groupBy("label").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("items"))
        parts = F.greatest(F.ceil(F.col("m") / LINK_SETS), F.ceil(F.col("items") / LINK_ITEMS)).cast("int")
        sizes = stage(sizes.where("m > 1").select("label", parts.alias("parts")), "sizes")
        mates = stage(groups.where("met").join(sizes, "label").select("n", "k1", "k2", "label", "c", "parts"), "mates")
        wanted = sets.join(small(mates), ["n", "k1", "k2"], "left_semi").select(F.col("rep").alias("doc_id")).distinct()
        wanted = small(stage(wanted, "wanted"))
        arrays = measured(self.docs.join(wanted, "doc_id", "left_semi"), rule, bits=True, items=True)
        dealt = (
            arrays.join(small(mates), ["n", "k1", "k2"])
            .withColumn("mine", F.pmod(F.xxhash64("k1", "k2"), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("label", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "k1", "k2", "c", "bits", "items")
        )
        run = lambda table: count_links(table, rule)
        counts = dealt.groupBy("label", "i", "j").applyInArrow(run, "k1 bigint, k2 bigint, links bigint")
        counts = stage(counts.groupBy("k1", "k2").agg(F.sum("links").alias("links")), "links")
        total = groups.join(counts, ["k1", "k2"], "left").select("n", "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("c") - 1).alias("links"))
        out = facts.join(stage(total, "totals"), ["n", "k1", "k2"], "left")
        links = F.when(F.col("doc_id").isNotNull(), F.coalesce("links", F.lit(0))).otherwise(0).cast("bigint")
        return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", links.alias("n_links"))


def count_links(table: pa.Table, rule: Rule) -> pa.Table:
    """Links within a tile: ``(k1, k2, links)``; the tile is a piece of a component, or two of its pieces."""
    names = np.stack([table.column(c).to_numpy() for c in ("k1", "k2")], axis=1)
    # rows of one doc_id or text can be repeated
    _, once = np.unique(names, axis=0, return_index=True)
    table, names = table.take(pa.array(once)).combine_chunks(), names[once]
    c, mine = (table.column(x).to_numpy() for x in ("c", "mine"))
    across = table.column("i")[0].as_py() != table.column("j")[0].as_py()
    items = table.column("items").combine_chunks()
    offsets, values = items.offsets.to_numpy(), items.values.to_numpy(zero_copy_only=False)
    n = np.diff(offsets).astype(np.int64)
    sets = [values[a:b].view(np.uint64) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    bits = [np.frombuffer(x, dtype=np.uint8) for x in table.column("bits").to_pylist()]
    size = min(map(len, bits), default=0)
    bits = np.stack([folded(b, size) for b in bits])
    kinds, place = np.unique(values[offsets[0] : offsets[-1]], return_inverse=True)
    starts, held = (offsets[:-1] - offsets[0]).astype(np.int64), np.zeros(len(kinds), dtype=np.int32)
    links = np.zeros(len(c), dtype=np.int64)
    for a in range(len(c)):
        js = np.arange(a + 1, len(c))
        if across:
            js = js[mine[js] != mine[a]]
        bound = overlap_bound(n[a], n[js], bits[a], bits[js])
        js = js[rule.den * bound >= rule.num * (n[a] + n[js] - bound)]
        if len(js) > 16:  # against all sets behind it at once
            own = place[starts[a] : starts[a] + n[a]]
            held[own] = 1
            both = np.add.reduceat(held[place[starts[js[0]] :]], starts[js[0] :] - starts[js[0]])
            # no set is empty, so each has a sum of its own
            both = both[js - js[0]].astype(np.int64)
            held[own] = 0
        else:
            both = np.array([common(sets[a], sets[j]) for j in js], dtype=np.int64)
        js = js[rule.den * both >= rule.num * (n[a] + n[js] - both)]
        links[a] += c[js].sum()
        links[js] += c[a]
    some = np.flatnonzero(links)
    cols = [pa.array(names[some, 0]), pa.array(names[some, 1]), pa.array(links[some])]
    return pa.Table.from_arrays(cols, names=["k1", "k2", "links"])


def link_counts(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_links)``: ``link_classes`` and the number of links of each row."""
    return NgramJoin(docs, rule or Rule()).linked()


def link_classes(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` by n-gram Jaccard similarity; see the module's text."""
    return NgramJoin(docs, rule or Rule()).classes()


def keep_one(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """``docs`` with one row of each class, the one with the smallest doc_id; all columns."""
    with scratch(docs.sparkSession):
        gone = link_classes(docs, rule).where("component_id <> doc_id").select(F.col("doc_id").alias("__d")).distinct()
        gone = stage(gone, "dropped", outlives=True)
    return docs.join(small(gone), F.col("doc_id") == F.col("__d"), "left_anti")
