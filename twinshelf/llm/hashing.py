"""Rolling polynomial hashes over arrays, modulo 2**64.

The hash of a run is the difference of two prefix sums times a power of the inverse base,
so all windows of a text are hashed at once. A last mixing step spreads the bits.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
PIECE = 1 << 22


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; kept for sizes of the next power of two."""
    return _powers(base, 1 << max(n - 1, 1).bit_length())[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial, one more than there are values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=out[1:])
    return out


def windows(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` values (uint64)."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = sums(values)
    return mix((total[size:] - total[:n]) * powers(INVERSE, n))


def words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of the text starts, and a hash of it; white space is the six
    ASCII characters. Long texts are taken in pieces that end at white space."""
    starts, hashes = [], []
    at = 0
    whole = np.frombuffer(data, np.uint8)
    while at < len(whole):
        end = min(at + PIECE, len(whole))
        if end < len(whole):
            gaps = np.flatnonzero(SPACES[whole[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # one word is longer than a piece
                gaps = np.flatnonzero(SPACES[whole[end:]])
                end = end + int(gaps[0]) + 1 if len(gaps) else len(whole)
        part = whole[at:end]
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = ~SPACES[part]
        edge = np.diff(inside)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(first):
            total = sums(part.astype(np.uint64) + np.uint64(1))
            starts.append(first + at)
            hashes.append(mix((total[last] - total[first]) * powers(INVERSE, len(part))[first]))
        at = end
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)
