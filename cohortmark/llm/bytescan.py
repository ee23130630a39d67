"""Vectorised word scanning over the UTF-8 bytes of many texts at once.

White space is ``[\\x20\\x09-\\x0D]``; every other byte belongs to a word. All of these are ASCII, so no
multi-byte character is ever cut.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CONTINUATION = np.zeros(256, bool)
CONTINUATION[0x80:0xC0] = True

U = np.uint64
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)
STEP = 0xD6E8FEB86659FD93
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        full = np.full(size, base, U)
        full[0] = 1
        have = np.multiply.accumulate(full)
        if size > 1 << 22:  # a very long text: not kept
            return have[:n]
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, last byte and row of each word of the texts data[off[i]:off[i + 1]]."""
    inside = ~SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    if len(data):
        at = off[:-1][off[:-1] < len(data)]
        begin = np.zeros(len(data) + 1, bool)
        begin[at] = True
        starts[1:] &= ~inside[:-1] | begin[1:-1]
        ends[:-1] &= ~inside[1:] | begin[1:-1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends)
    return first, last, np.searchsorted(off, first, "right") - 1


def span_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span data[first..last]; equal bytes give equal hashes wherever they stand."""
    if not len(first):
        return np.zeros(0, U)
    total = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * powers(BASE, len(data)), out=total[1:])
    return mix((total[last + 1] - total[first]) * powers(BASE_INV, len(data))[first] + (last - first).astype(U))


def window_hashes(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each run of k neighbouring words of one row, and the index of its first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    total = hashes[:n].copy()
    for j in range(1, k):
        total *= U(STEP)
        total += hashes[j : j + n]
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    return mix(total[at]), at
