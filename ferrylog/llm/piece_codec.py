"""SentencePiece encoding and decoding: an Aho-Corasick automaton drives a single-pass Viterbi search.

The automaton of all pieces reads a text once. At each character its output links name every piece that
ends there; each relaxes what is known at its end from what is known at its start. There is one pass and two
rules of relaxing:

- ``Codec`` maximises the sum of piece scores, the semantics of unigram models. A character that no piece
  covers costs ``lowest score - 10``. Of segmentations with equal sums the one whose last piece is longest
  wins, then the same rule before it.
- ``MergeCodec`` takes the pieces that merging neighbours in order of score leaves, the semantics of models
  trained by pair merging, where scores are the places of merges and mean nothing as a sum. Whether two
  neighbouring pieces stay apart is decided by the two alone. So at each end one piece is kept: the longest
  one that stays apart from the piece kept at its start. Tracing back gives the ids of the model's own
  tokenizer.

A character that no piece covers is written as its UTF-8 bytes (or as the unknown piece, if the model has no
bytes). ``encode(.., as_trained=True)`` takes the rule that the model was trained for.

White space is escaped and a dummy prefix added as the model's settings say; models that map characters
are given their library's normalised text. Pieces hold the escape
mark at their beginning only, so the search can be cut before each run of marks without losing a
segmentation; stretches are searched once per worker while they are kept, as packed ids, in a table of bounded size
that lets go of those not met lately. If a
model has other pieces, texts are searched in one go.

Results in special cases: null and empty texts have no pieces and decode to an empty text; a text that
holds the escape mark itself decodes to one with a space there; unknown pieces decode to their surface
mark; ids outside the model raise ValueError; an empty table gives no row. Texts are never cut off.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import pairwise, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ferrylog.session import bounded_batches

#: Fixed values of the model format: the escape mark, piece types, the penalty of unknown characters.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
MERGES = 2  # the model type of pair merging
UNKNOWN_SURFACE = " ⁇ "
KEPT_STRETCHES = 100_000
KEPT_PAIRS = 400_000
START = -2  # before the first character


class Stretches(dict):
    """Packed ids of the stretches met lately, half of ``KEPT_STRETCHES`` and as many from before; others are searched."""

    def __init__(self, search: Callable[[str], list[int]]):
        super().__init__()
        self.search = search
        self.older: dict[str, bytes] = {}

    def __missing__(self, stretch: str) -> bytes:
        ids = self.older.get(stretch)
        if ids is None:
            ids = array("i", self.search(stretch)).tobytes()
        if len(stretch) <= 64:
            if len(self) >= KEPT_STRETCHES // 2:
                self.older = dict(self)
                self.clear()
            self[stretch] = ids
        return ids


class Codec:
    """Encoder and decoder of one model file, given as bytes."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        self.library = None
        if spec.precompiled_charsmap:
            from sentencepiece import SentencePieceProcessor

            self.library = SentencePieceProcessor(model_proto=model)
        self.prefix, self.squeeze, self.escape = (
            spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        )
        self.pieces = [(p.piece, p.score, p.type) for p in proto.pieces]
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE}
        self.unknown = next(i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN)
        usable = {p: (i, s, kind) for i, (p, s, kind) in enumerate(self.pieces) if kind in (NORMAL, USER)}
        normal = [s for _, s, kind in usable.values() if kind == NORMAL]
        self.penalty = min(normal, default=0.0) - UNKNOWN_PENALTY
        highest = max(normal, default=0.0)
        self.automaton = ahocorasick.Automaton()
        for piece, (i, score, kind) in usable.items():
            score = len(piece) * highest - 0.1 if kind == USER else score
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.single = {p for p in usable if len(p) == 1}
        inner = {c for p in usable for a, c in zip(p, p[1:]) if c == MARK and a != MARK}
        lines = any("\n" in p and len(p) > 1 for p in usable)
        cut = f"{MARK}*[^{MARK}]+|{MARK}+" if lines else f"\n|{MARK}*[^{MARK}\n]+|{MARK}+"
        self.cut = re.compile("(?s).+" if inner else cut).findall
        self.kept = Stretches(self.search)
        # pieces that stand for the same characters wherever they are, ASCII bytes such as the line feed among them
        self.spelled = [p.replace(MARK, " ") if self.escape else p for p, _, _ in self.pieces]
        self.marked = {i for i, (_, _, kind) in enumerate(self.pieces) if kind in (UNKNOWN, CONTROL, BYTE)}
        for i in [i for i in self.marked if self.pieces[i][2] == BYTE and int(self.pieces[i][0][3:5], 16) < 128]:
            self.spelled[i] = chr(int(self.pieces[i][0][3:5], 16))
            self.marked.remove(i)

    def normalised(self, text: str) -> str:
        """The text as the pieces spell it."""
        if self.library is not None:
            return self.library.Normalize(text)
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if text and self.prefix:
            text = " " + text
        return text.replace(" ", MARK) if self.escape else text

    def search(self, stretch: str) -> list[int]:
        """The best segmentation of a stretch, as ids."""
        n = len(stretch)
        best, back = [0.0] + [-np.inf] * n, [(0, 0)] * (n + 1)
        covered = self.single.issuperset(stretch)
        filled = 0
        for end, (length, score, piece) in self.automaton.iter(stretch):
            if not covered:
                filled = self._bridge(stretch, best, back, filled, end)
            at = end + 1 - length
            value = best[at] + score
            if value > best[end + 1] or value == best[end + 1] and length > back[end + 1][0]:
                best[end + 1] = value
                back[end + 1] = (length, piece)
        if not covered:
            self._bridge(stretch, best, back, filled, n)
        ids, at = [], n
        while at:
            length, piece = back[at]
            at -= length
            if piece >= 0:
                ids.append(piece)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in reversed(stretch[at].encode()))
            else:
                ids.append(self.unknown)
        ids.reverse()
        return ids

    def _bridge(self, stretch: str, best: list, back: list, filled: int, upto: int) -> int:
        """Let unknown characters pass, up to the one that ends at ``upto``."""
        while filled < min(upto + 1, len(stretch)):
            if stretch[filled] not in self.single and best[filled] + self.penalty > best[filled + 1]:
                best[filled + 1] = best[filled] + self.penalty
                back[filled + 1] = (1, -1)
            filled += 1
        return filled

    def ids(self, text: str | None) -> np.ndarray:
        """The ids of a text, as an array."""
        stretches = self.cut(self.normalised(text or ""))
        return np.frombuffer(b"".join(map(self.kept.__getitem__, stretches)), dtype=np.intc)

    def encode(self, text: str | None) -> list[int]:
        return self.ids(text).tolist()

    def decode(self, ids: Sequence[int]) -> str:
        if self.marked.isdisjoint(ids) and 0 <= min(ids, default=0) and max(ids, default=0) < len(self.pieces):
            text = "".join(map(self.spelled.__getitem__, ids))
            return text.removeprefix(" ") if self.prefix else text
        out, held = [], bytearray()
        for i in ids:
            if not 0 <= i < len(self.pieces):
                raise ValueError(f"no piece has the id {i}")
            piece, _, kind = self.pieces[i]
            if kind == BYTE:
                held.append(int(piece[3:5], 16))
                continue
            if held:
                out.append(held.decode(errors="replace"))
                held.clear()
            if kind != CONTROL:
                out.append(UNKNOWN_SURFACE if kind == UNKNOWN else piece)
        if held:
            out.append(held.decode(errors="replace"))
        text = "".join(out).replace(MARK, " ") if self.escape else "".join(out)
        return text.removeprefix(" ") if self.prefix else text


class MergeCodec(Codec):
    """Codec of a model trained by pair merging: of all neighbours the pair with the highest score is merged first."""

    def __init__(self, model: bytes):
        super().__init__(model)
        # a piece that is listed twice counts by its last place
        self.known = {p: (s, i, kind) for i, (p, s, kind) in enumerate(self.pieces) if kind in (NORMAL, USER, UNUSED)}
        # pieces of users are found first and are not merged with others
        users = sorted((p for p, (_, _, kind) in self.known.items() if kind == USER), key=len, reverse=True)
        self.users = re.compile("|".join(map(re.escape, users))) if users else None
        merged = {p: (-s, i, kind) for p, (s, i, kind) in self.known.items() if kind != USER}
        self.turns = {p: turn for p, (turn, _, _) in merged.items()}
        self.unused = {i for _, i, kind in merged.values() if kind == UNUSED}
        if len(merged) < len(self.known) or self.unused:
            self.cut = re.compile("(?s).+").findall
        self.names = {i: p for p, (_, i, _) in merged.items()}
        self.single = {p: i for p, (_, i, _) in merged.items() if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        # a single character stands for itself where nothing longer is kept, so it need not be found
        for piece in [p for p in merged if len(p) > 1] or merged:
            # beside each piece the pieces before it that are known to stay apart from it, or not
            self.automaton.add_word(piece, (len(piece), merged[piece][1], {}))
        self.automaton.make_automaton()
        self.pairs = 0
        self.kept = Stretches(self._pass if self.users is None else self.search)

    def merged(self, text: str, until: int = 1) -> list[str]:
        """What merging leaves of a short text, by looking through all pairs; stops at ``until`` parts."""
        parts, turn, never = list(text), self.turns.get, np.inf
        turns = [turn(a + b, never) for a, b in pairwise(parts)]
        while len(parts) > until:
            first = min(turns)
            if first == never:
                break
            at = turns.index(first)
            parts[at] += parts.pop(at + 1)
            del turns[at]
            if at:
                turns[at - 1] = turn(parts[at - 1] + parts[at], never)
            if at < len(turns):
                turns[at] = turn(parts[at] + parts[at + 1], never)
        return parts

    def apart(self, known: dict[int, bool], before: int, spelled: str, piece: int) -> bool:
        """Whether a piece is left as it is beside the one before it, spelled ``spelled``, or alone at the ``START``."""
        parts = [spelled, self.names[piece]] if before != START else [self.names[piece]]
        fits = self.merged("".join(parts)) == parts
        if before != -1:  # characters without a piece differ
            if self.pairs >= KEPT_PAIRS:
                self.pairs = 0
                for _, _, pairs in self.automaton.values():
                    pairs.clear()
            self.pairs += 1
            known[before] = fits
        return fits

    def search(self, stretch: str) -> list[int]:
        """The segmentation that the merges leave, as ids; of pairs with equal scores the first one goes first."""
        if self.users is None:
            return self._pass(stretch)
        ids, at = [], 0
        for found in self.users.finditer(stretch):
            ids += self._pass(stretch[at : found.start()]) + [self.known[found[0]][1]]
            at = found.end()
        return ids + self._pass(stretch[at:])

    def _pass(self, stretch: str) -> list[int]:
        # the piece kept at each character, at first its own, -1 for none; the last place stands before the first character
        kept = [*map(self.single.get, stretch, repeat(-1)), START]
        # the character before a longer piece that is kept
        back: list[int | None] = [None] * len(stretch)
        for end, (length, piece, known) in self.automaton.iter(stretch):
            if back[end] is not None:  # output links go from long to short
                continue
            at = end - length
            before = kept[at]
            fits = known.get(before)
            if fits is None:
                spelled = stretch[at if back[at] is None else back[at] + 1 : at + 1] if before != START else ""
                fits = self.apart(known, before, spelled, piece)
            if fits:
                kept[end], back[end] = piece, at
        ids, at, unused = [], len(stretch) - 1, self.unused
        while at >= 0:
            piece, begin = kept[at], back[at]
            if begin is None:
                begin = at - 1
            if piece >= 0 and piece not in unused:
                ids.append(piece)
            else:
                ids.extend(reversed(self._named(stretch[begin + 1 : at + 1])))
            at = begin
        ids.reverse()
        return ids

    def _named(self, part: str) -> list[int]:
        """Ids of an unused piece, taken apart into what it was made of, or of a character without a piece."""
        ids: list[int] = []
        todo = [part]
        while todo:
            part = todo.pop()
            hit = self.known.get(part)
            if hit is not None and hit[2] == UNUSED and len(part) > 1:
                todo += reversed(self.merged(part, until=2))
            elif hit is not None:
                ids.append(hit[1])
            elif self.bytes:
                ids.extend(self.bytes[b] for b in part.encode())
            else:
                ids.append(self.unknown)
        return ids

    def ids(self, text: str | None) -> np.ndarray:
        ids = super().ids(text)
        if self.bytes:
            return ids
        # a run of unknown characters is one unknown piece
        return ids[np.r_[True, (ids[1:] != self.unknown) | (ids[:-1] != self.unknown)][: len(ids)]]


@lru_cache(maxsize=2)
def codec(model: bytes, as_trained: bool = False) -> Codec:
    """One codec per model and Python worker."""
    return MergeCodec(model) if as_trained and model_type(model) == MERGES else Codec(model)


def model_type(model: bytes) -> int:
    """How the model was trained."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    return proto.trainer_spec.model_type


def read_model(path: str) -> bytes:
    """The model file, half a megabyte or so, which is sent with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes, *, as_trained: bool = False) -> DataFrame:
    """``(doc_id, n_pieces, ids, ids_sha256, round_trip)``, a row per row of ``docs(doc_id, text)``.

    ``as_trained`` takes the segmentation that the model was trained for, by merges or by scores.
    ``ids_sha256`` is the digest of the ids as little-endian 32-bit numbers; ``round_trip`` tells
    whether decoding them gives the text again.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(model, as_trained)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield _encoded(one, part.column("doc_id"), part.column("text"))

    def _encoded(one: Codec, doc_ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        texts = texts.to_pylist()
        rows = [one.ids(t).astype("<i4", copy=False) for t in texts]
        same = [one.decode(ids.tolist()) == (t or "") for ids, t in zip(rows, texts, strict=True)]
        sizes = np.array([len(ids) for ids in rows], dtype=np.int64)
        values = pa.array(np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32), pa.int32())
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), values)
        digests = pa.array([hashlib.sha256(ids.tobytes()).hexdigest() for ids in rows], pa.string())
        names = ["doc_id", "n_pieces", "ids", "ids_sha256", "round_trip"]
        return pa.RecordBatch.from_arrays([doc_ids, pa.array(sizes), lists, digests, pa.array(same, pa.bool_())], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_pieces bigint, ids array<int>, ids_sha256 string, round_trip boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(rows: DataFrame, model: bytes) -> DataFrame:
    """``(doc_id, text)`` of ``rows(doc_id, ids)``; null ids give a null text."""
    bounded_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(model)
        for batch in batches:
            texts = [None if ids is None else one.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
