"""Minimal perfect hashing of 64-bit keys with numpy.

Level by level, keys that meet no other key in a bit array of twice their number take their bit; the rest go to the next
level with another mixing. A key's index is the number of set bits before its own. Keys that no level parts (equal keys
among them) are listed after the levels, so building always ends.
"""

from __future__ import annotations

import numpy as np

LEVELS = 48


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser, another one for each seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) ^ np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


class PerfectHash:
    def __init__(self, bits: list[np.ndarray], last: np.ndarray):
        self.sizes = [len(b) for b in bits]
        self.bits = bits
        self.last = last
        self.before, start = [], 0
        for b in bits:
            ranks = np.cumsum(b, dtype=np.int64)
            self.before.append(start + ranks - b)
            start += int(ranks[-1])
        self.start_of_last = start

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        bits, keys = [], keys.astype(np.uint64)
        while len(keys) and len(bits) < LEVELS:
            at = (mixed(keys, len(bits)) % np.uint64(max(64, 2 * len(keys)))).astype(np.int64)
            taken = np.bincount(at, minlength=max(64, 2 * len(keys))) == 1
            bits.append(taken)
            keys = keys[~taken[at]]
        return cls(bits, keys)

    def __len__(self) -> int:
        return self.start_of_last + len(self.last)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; some index or -1 for a key that was not among those built from."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for level, (taken, before) in enumerate(zip(self.bits, self.before)):
            if not len(todo):
                return out
            at = (mixed(keys[todo], level) % np.uint64(len(taken))).astype(np.int64)
            hit = taken[at]
            out[todo[hit]] = before[at[hit]]
            todo = todo[~hit]
        if len(self.last) and len(todo):
            order = np.argsort(self.last, kind="stable")
            at = np.minimum(np.searchsorted(self.last[order], keys[todo]), len(self.last) - 1)
            hit = self.last[order][at] == keys[todo]
            out[todo[hit]] = self.start_of_last + order[at[hit]]
        return out

    def dump(self) -> bytes:
        head = np.array([len(self.sizes), *self.sizes, len(self.last)], dtype="<i8").tobytes()
        return head + b"".join(np.packbits(b).tobytes() for b in self.bits) + self.last.astype("<u8").tobytes()

    @classmethod
    def load(cls, held: bytes) -> PerfectHash:
        n = int(np.frombuffer(held, "<i8", 1)[0])
        sizes = np.frombuffer(held, "<i8", n + 1, 8)
        at, bits = 8 * (n + 2), []
        for size in sizes[:n]:
            n_bytes = (int(size) + 7) // 8
            bits.append(np.unpackbits(np.frombuffer(held, np.uint8, n_bytes, at), count=int(size)).astype(bool))
            at += n_bytes
        return cls(bits, np.frombuffer(held, "<u8", int(sizes[n]), at))
