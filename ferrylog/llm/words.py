"""Words and hashes of whole texts, computed on the bytes of Arrow columns with numpy.

White space is the six ASCII characters, and only A-Z are lower-cased, so both can be decided byte by
byte in UTF-8. Texts are handled in slices of a quarter of a megabyte, whatever the size of an Arrow batch,
since numpy needs a hundred times a slice for a moment; a longer text is a slice of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = np.random.default_rng(7).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers in which every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows; a null counts as an empty text."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, first + 1), len(texts))
        yield first, end, raw[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


class Words:
    """Places and 64-bit hashes of the words of one slice.

    ``hashes`` are in text order, ``counts`` gives the number of words of each row, ``bounds`` where the
    words of each row begin and end.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = True):
        solid = np.flatnonzero(~_SPACE[raw])
        row = np.searchsorted(offsets, solid, side="right") if len(solid) else solid
        begins = np.ones(len(solid), dtype=bool)
        begins[1:] = (np.diff(solid) > 1) | (np.diff(row) > 0)
        self.at = np.flatnonzero(begins)
        self.lengths = np.diff(np.append(self.at, len(solid)))
        self.starts = solid[self.at]
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)
        self.letters = (_LOWER[raw] if lower else raw)[solid]
        self.hashes = self._hashes()

    def _hashes(self) -> np.ndarray:
        if not len(self.at):
            return np.zeros(0, dtype=np.uint64)
        # eight bytes are one number; each is mixed with a key of its place before they are summed, as a sum
        # of powers has colliding words for every base
        inside = np.arange(len(self.letters)) - np.repeat(self.at, self.lengths)
        shift = ((inside & 7) << 3).astype(np.uint64)
        begins = np.flatnonzero(shift == 0)
        eights = np.add.reduceat(self.letters.astype(np.uint64) << shift, begins)
        keys = mix(((inside[begins] >> 3) + 1).astype(np.uint64) * _BASE)
        sums = np.add.reduceat(mix(eights ^ keys), np.searchsorted(begins, self.at))
        return mix(sums + self.lengths.astype(np.uint64) * _BASE)

    def prefix_hashes(self, length: int) -> np.ndarray:
        """Hash of the first ``length`` bytes of each word (of all of it, if it is shorter)."""
        if not len(self.at):
            return np.zeros(0, dtype=np.uint64)
        out = np.full(len(self.at), np.uint64(length))
        for i in range(length):
            has = self.lengths > i
            step = _BYTE[self.letters[np.where(has, self.at + i, self.at)]]
            out = np.where(has, out * _BASE + step, out)
        return mix(out)


def shingles(words: Words, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the ``size``-word shingles of each row; of all its words, if it has fewer."""
    with np.errstate(over="ignore"):
        weights = mix(np.arange(1, size + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
        h = words.hashes
        every = np.zeros(max(len(h) - size + 1, 0), dtype=np.uint64)
        for i in range(size):
            every += h[i : i + len(every)] * weights[i]
        every = mix(every)
        for begin, end in zip(words.bounds[:-1], words.bounds[1:], strict=True):
            n = end - begin
            if n >= size:
                yield np.unique(every[begin : end - size + 1])
            elif n:
                yield mix(np.array([(h[begin:end] * weights[:n]).sum() + np.uint64(n)], dtype=np.uint64))
            else:
                yield np.zeros(0, dtype=np.uint64)
