"""Hashes of many substrings of a byte array at once, by sums that wrap at 64 bits."""

from __future__ import annotations

import numpy as np

#: A random 64-bit number per byte value, an odd base and its inverse modulo 2**64.
TABLE = np.random.default_rng(20).integers(0, 2 ** 64, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2 ** 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Substrings:
    """64-bit hashes of slices of ``data``: equal slices have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray, table: np.ndarray = TABLE):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(table[data] * powers(BASE, len(data)), out=self.sums[1:])
        self.shift = powers(INVERSE, len(data) + 1)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.shift[starts]
        return mix(raw + (ends - starts).astype(np.uint64))
