"""Letters of whole texts as code points, and hashes of their n-grams."""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np

from quotepanel.llm.textbytes import MULTIPLIER, Texts, mix

SPACE = 32


@lru_cache(maxsize=1)
def folded() -> np.ndarray:
    """For every code point its lower-case letter, or a space if it is no letter."""
    table = np.full(sys.maxunicode + 1, SPACE, np.uint32)
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def letters(texts: Texts, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """Folded letters of all texts and where each text's begin.

    Runs of other characters become one space; every text begins with
    ``lead`` spaces and ends with one.
    """
    point = np.frombuffer(texts.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    is_start = (texts.data & 0xC0) != 0x80
    upto = np.concatenate([[0], np.cumsum(is_start)])[texts.offsets]
    code = folded()[point]
    space = code == SPACE
    # A space after a space goes, and so does one at a text's start, after the lead.
    after_space = np.ones(len(code), bool)
    after_space[1:] = space[:-1]
    after_space[upto[:-1][upto[:-1] < len(code)]] = True
    keep = ~(space & after_space)
    kept = np.flatnonzero(keep)
    end = np.searchsorted(kept, upto[1:]) - 1
    end = kept[end[(end >= 0) & (np.diff(upto) > 0)]]
    keep[end[space[end]]] = False
    kept_upto = np.concatenate([[0], np.cumsum(keep)])[upto]
    size = np.diff(kept_upto)
    first = np.concatenate([[0], np.cumsum(size + lead + 1)])
    out = np.full(int(first[-1]), SPACE, np.uint64)
    shift = first[:-1] + lead - kept_upto[:-1]
    out[np.arange(int(kept_upto[-1])) + np.repeat(shift, size)] = code[keep]
    return out, first


def gram_keys(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` codes that end at each place from ``n - 1`` on."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(codes) - n + 1, np.uint64)
    for i in range(n):
        out = out * MULTIPLIER + codes[i : len(codes) - n + 1 + i] + np.uint64(1)
    return mix(out * MULTIPLIER + np.uint64(n))


def gram_keys_at(codes: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """The same hash for the ``n`` codes from each place in ``start`` on."""
    out = np.zeros(len(start), np.uint64)
    for i in range(n):
        out = out * MULTIPLIER + codes[start + i] + np.uint64(1)
    return mix(out * MULTIPLIER + np.uint64(n))
