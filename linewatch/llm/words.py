"""Words of whole texts as numpy arrays, cut and hashed on the UTF-8 bytes of an Arrow column.

A word is a longest run without the bytes 0x20 and 0x09 to 0x0D, which are ASCII and so never
part of another character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text looked at together; a longer text is a slice of its own.
SLICE_BYTES = 2_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix: spreads every bit of a hash over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2^64 and their inverses, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up, self.down


_BYTES, _WORDS = Powers(_BASE), Powers(0xD6E8FEB86659FD93)


@dataclass
class Words:
    data: np.ndarray      # bytes of all texts of the slice
    text_at: np.ndarray   # where each text starts in data, and the end
    start: np.ndarray     # where each word starts in data
    end: np.ndarray
    word_at: np.ndarray   # the first word of each text, and the number of words
    _sums: np.ndarray | None = None

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.text_at) - 1), np.diff(self.word_at))

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each byte span of data."""
        up, down = _BYTES.get(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)],
                      out=self._sums[1:])
        h = (self._sums[end] - self._sums[start]) * down[start]
        return mixed(h + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.start, self.end)


def slices(texts: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(from, to) row ranges of at most slice_bytes each, or of one text."""
    size = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[
        texts.offset: texts.offset + len(texts) + 1]) if len(texts) else np.zeros(0)
    at, n = 0, 0
    for i, s in enumerate(size):
        if i > at and n + s > slice_bytes:
            yield at, i
            at, n = i, 0
        n += s
    if len(texts):
        yield at, len(texts)


def large(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column with 64-bit offsets, nulls as empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    return texts.fill_null("") if texts.null_count else texts


def cut(texts: pa.Array, lower: bool = False) -> Words:
    """Words of a column made by large(); lower turns A-Z to lower case first."""
    n = len(texts)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), np.zeros(1, np.int64), none, none, np.zeros(1, np.int64))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + n + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[first:last] if raw is not None and last > first \
        else np.zeros(0, np.uint8)
    if lower:
        data = _LOWER[data]
    text_at = offsets - first
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    starts = inside[1:] & ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    # a text's edge also ends a word
    edge = text_at[(text_at > 0) & (text_at < len(data))]
    edge = edge[inside[edge] & inside[edge + 1]]
    starts[edge] = True
    ends[edge] = True
    start, end = np.flatnonzero(starts), np.flatnonzero(ends)
    return Words(data, text_at, start, end, np.searchsorted(start, text_at))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of `size` word hashes; shorter than the input by size - 1."""
    n = len(words)
    if n < size:
        return np.zeros(0, np.uint64)
    up, down = _WORDS.get(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up[:n], out=sums[1:])
    return mixed((sums[size:] - sums[:-size]) * down[: n - size + 1])


def windows(w: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of all runs of `size` words that lie in one text."""
    h = window_hashes(hashes, size)
    left = np.repeat(w.word_at[1:], np.diff(w.word_at))[: len(h)]  # where the word's text ends
    at = np.flatnonzero(np.arange(len(h)) + size <= left)
    return at, h[at]
