"""Words, hashes and groups of whole Arrow batches with numpy, inside Spark tasks.

A text is its UTF-8 bytes, null counts as empty. Separators are ASCII, so a
byte-wise split never cuts a code point.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from quotepanel.llm.common import SEPARATORS

#: Bytes of text that are worked on at once; a longer text is worked on alone and whole.
SLICE_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
BYTE_HASH = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
IS_SEPARATOR = np.zeros(256, bool)
IS_SEPARATOR[list(SEPARATORS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of a common public hash)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Texts:
    """Some rows of a batch: ``data[offsets[i]:offsets[i + 1]]`` is text ``i``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The rows of a string column, a few at a time and each of them whole."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        end = min(end, n)
        yield Texts(at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
        at = end


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray  # row in the slice
    first: np.ndarray  # for each row, its first word; one more at the end


def words(texts: Texts) -> Words:
    n = len(texts.data)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = ~IS_SEPARATOR[texts.data]
    # Texts follow each other without a gap, so a text's start and end part words too.
    edge = np.diff(inside)
    starts = edge[:-1] == 1 if n else np.zeros(0, bool)
    ends = edge[1:] == -1 if n else np.zeros(0, bool)
    cut = texts.offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    word = inside[1:-1].astype(bool)
    starts = starts.copy()
    ends = ends.copy()
    starts[cut[word[cut]]] = True
    ends[cut[word[cut - 1]] - 1] = True
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, texts.offsets, "left")
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(start, end, doc, first)


def word_hashes(data: np.ndarray, w: Words) -> np.ndarray:
    """64 bits per word: byte hashes weighed by powers of an odd number, then mixed."""
    if not len(w.start):
        return np.zeros(0, np.uint64)
    length = (w.end - w.start).astype(np.int64)
    longest = int(length.max())
    power = np.ones(longest, np.uint64)
    if longest > 1:
        power[1:] = np.multiply.accumulate(np.full(longest - 1, MULTIPLIER, np.uint64))
    total = int(length.sum())
    begin = np.cumsum(length) - length
    place = np.arange(total) - np.repeat(begin, length)
    at = place + np.repeat(w.start, length)
    value = BYTE_HASH[data[at]] * power[place]
    return mix(np.add.reduceat(value, begin) + length.astype(np.uint64) * MULTIPLIER)


def word_windows(h: np.ndarray, w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``k`` words inside one text, and the index of its first word."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        out = mix(out * MULTIPLIER + h[i : n - k + 1 + i])
    at = np.flatnonzero(w.doc[: n - k + 1] == w.doc[k - 1 :])
    return out[at], at


def shingle_sets(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text its distinct ``k``-word shingles as hashes, ascending, and where each text's begin.

    Upper-case ASCII counts as lower case. A text with fewer than ``k`` words
    has its whole sequence as one shingle, a text without words has none.
    """
    texts = Texts(texts.first, LOWER[texts.data], texts.offsets)
    w = words(texts)
    h = word_hashes(texts.data, w)
    value, at = word_windows(h, w, k)
    doc = w.doc[at]
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            has = count[short] > i
            extra[has] = mix(extra[has] * MULTIPLIER + h[w.first[short[has]] + i])
        extra = mix(extra + count[short].astype(np.uint64))
        value, doc = np.concatenate([value, extra]), np.concatenate([doc, short])
    if len(short):
        order = np.argsort(doc, kind="stable")
        value, doc = value[order], doc[order]
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    sets = [np.unique(value[first[i] : first[i + 1]]) for i in range(len(texts))]
    sizes = np.array([len(x) for x in sets], np.int64)
    return np.concatenate(sets) if sets else value, np.concatenate([[0], np.cumsum(sizes)])


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of a first occurrence of each value, and for each element its value's number."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    number = np.empty(len(s), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the borders in ``first``."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]
