"""Words of many texts at once in numpy.

A word is a run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; UTF-8 keeps every other character clear
of those bytes, so working on bytes gives the same words as working on characters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_RNG = np.random.default_rng(20240607)
_OF_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Powers that are kept; longer tables, for texts longer than a slice, are made for the call.
_KEPT = 1 << 20


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    n = 1 << (n - 1).bit_length()
    made = []
    for base in (_STEP, _BACK):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        made.append(np.multiply.accumulate(p, out=p))
    if n <= _KEPT:
        _powers[:] = made
    return made[0], made[1]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each values[start:end]: a polynomial from prefix sums, then mixed with the length."""
    n = len(values)
    up, down = _power(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + mix((end - start).astype(np.uint64)))


@dataclass
class Words:
    """Words of some texts, in order.  ``first`` has the n + 1 places where each text's words begin."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def words(data: np.ndarray, at: np.ndarray, lower: bool) -> Words:
    """``data``: the texts' bytes one after the other; ``at``: their n + 1 offsets."""
    data = _LOWER[data] if lower else data
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    edges = at[1:-1]
    before[edges[edges < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, at), span_hashes(_OF_BYTE[data], start, end))


def windows(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows that stay within a text, and the n + 1 places where each text's begin."""
    if len(w.hash) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(w.first), np.int64)
    counts = np.maximum(np.diff(w.first) - n + 1, 0)
    first = np.concatenate(([0], np.cumsum(counts)))
    start = np.repeat(w.first[:-1] - first[:-1], counts) + np.arange(first[-1])
    return span_hashes(w.hash, start, start + n), first


def code_points(w: Words) -> np.ndarray:
    """Of each word: its bytes that don't continue a character."""
    total = np.concatenate(([0], np.cumsum((w.data & 0xC0) != 0x80)))
    return total[w.end] - total[w.start]
