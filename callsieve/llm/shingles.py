"""Sets of word shingles of whole texts, for many texts at once with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .bytehash import BASE, INVERSE, TABLE, mix, powers

WORDS, SLICE = 5, 1 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Capitals hash as their small letters.
FOLDED = TABLE.copy()
FOLDED[65:91] = TABLE[97:123]
PLACES = np.random.default_rng(5).integers(0, 2 ** 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_held = {"n": 0}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > SLICE + 1:
        return powers(BASE, n), powers(INVERSE, n)
    if not _held["n"]:
        _held.update(n=SLICE + 1, up=powers(BASE, SLICE + 1), down=powers(INVERSE, SLICE + 1))
    return _held["up"][:n], _held["down"][:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word, slice by slice so that memory does not follow the length of a text."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE, side="right")))
        low, high = int(starts[i]), int(ends[j - 1])
        up, down = _powers(high - low + 1)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(FOLDED[data[low:high]] * up[:-1], out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end (null as empty), and where each begins and the last ends."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8)[offsets[0]:offsets[-1]] if held is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: int, most_bytes: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose texts have about ``most_bytes`` bytes; a longer text is a run of its own."""
    _, ends = text_bytes(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most_bytes, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text: five words each, the whole sequence when shorter, none without words."""
    data, offsets = text_bytes(column)
    space = SPACE[data]
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    before, after = np.empty(len(data), dtype=bool), np.empty(len(data), dtype=bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[offsets[full]] = True
    after[offsets[full + 1] - 1] = True
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    del before, after, space
    words = word_hashes(data, starts, ends)
    first = np.searchsorted(starts, offsets)
    if len(words) >= WORDS:
        every = sum(words[j:len(words) - WORDS + 1 + j] * PLACES[j] for j in range(WORDS))
        every = mix(every)
    else:
        every = np.zeros(0, dtype=np.uint64)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        n = b - a
        if n >= WORDS:
            own = np.sort(every[a:b - WORDS + 1])
            if n > WORDS:
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            yield own
        elif n:
            yield mix(np.array([np.add.reduce(words[a:b] * PLACES[:n]) + np.uint64(n)], dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)
