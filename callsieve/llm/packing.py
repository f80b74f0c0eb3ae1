"""Documents as token sequences of fixed length by best-fit decreasing.

Texts become token ids plus a closing id; longer documents are cut so that all pieces but the first are full.
Pieces are dealt to chunks of some 20,000 by a hash, and each chunk is packed by itself: longest piece first, into the
open sequence that it fills most tightly. A segment tree over remaining capacities finds that sequence in logarithmic
time. Only the last sequences of a chunk stay partly open, so chunks cost about one sequence in five thousand.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, small_batches, written
from .tokens import Ids

LENGTH = 2048


class BestFit:
    """Open sequences by remaining capacity; a segment tree of counts finds the tightest that is large enough."""

    def __init__(self, length: int):
        self.length, self.leaves = length, 1 << length.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(length + 1)]
        self.used: list[int] = []

    def _add(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.counts[node] += by
            node >>= 1

    def _tightest(self, least: int) -> int | None:
        node = least + self.leaves
        if self.counts[node]:
            return least
        while node > 1 and not (node % 2 == 0 and self.counts[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node = 2 * node + (not self.counts[2 * node])
        return node - self.leaves

    def place(self, size: int) -> tuple[int, int]:
        """Sequence number and offset for a piece."""
        capacity = self._tightest(size)
        if capacity is None:
            number, capacity = len(self.used), self.length
            self.used.append(0)
        else:
            number = self.open[capacity].pop()
            self._add(capacity, -1)
        offset = self.used[number]
        self.used[number] = offset + size
        if capacity > size:
            self.open[capacity - size].append(number)
            self._add(capacity - size, 1)
        return number, offset


def tokenised(docs: DataFrame, length: int = LENGTH, closing: int = 0, vocabulary: str | None = None,
              ranks: str | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and ids (little-endian 32-bit; null unless ``with_ids``) of every piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Ids(vocabulary, ranks)
        end = np.array([closing], dtype="<u4").tobytes()
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            held = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                n = len(ids) // 4
                first = n % length or length
                for piece, start in enumerate([0, *range(first, n, length)]):
                    size = first if piece == 0 else length
                    part = ids[4 * start:4 * (start + size)]
                    for values, value in zip(out, (doc_id, piece, start, size, zlib.crc32(part), part if with_ids else None)):
                        values.append(value)
                held += len(ids)
                if held > 32_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, TYPES)], names=NAMES)
                    out, held = ([], [], [], [], [], []), 0
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, TYPES)], names=NAMES)

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def packed(pieces: DataFrame, length: int = LENGTH, chunk_rows: int = 20_000) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32; other columns are not carried).

    Sequence ids are unique, not gapless. Pieces longer than ``length`` are an error. Repeated rows are packed as
    rows of their own; an empty table gives an empty result.
    """
    pieces = written(pieces.select("doc_id", "piece", "start", "length", "ids_crc32"))
    n_chunks = pieces_of(pieces.count(), chunk_rows)
    chunked = pieces.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_chunks)))

    def fit(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins = BestFit(length)
        places = np.array([bins.place(int(x)) for x in chunk["length"]], dtype=np.int64).reshape(-1, 2)
        chunk["sequence_id"] = (chunk["chunk"].to_numpy(dtype=np.int64) << 32) + places[:, 0]
        chunk["offset"] = places[:, 1]
        return chunk.drop(columns="chunk")

    return chunked.groupBy("chunk").applyInPandas(
        fit, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def sequences(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Where every piece of every document of ``docs`` (doc_id, text; other columns are ignored) stands.

    Null texts count as empty: one piece with the closing id. Null ids are kept. Whole texts are read.
    """
    return packed(tokenised(docs, length, with_ids=False), length)
