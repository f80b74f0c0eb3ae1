"""Repeated lines dropped by probing a sharded perfect-hash index.

Every document sends the distinct 128-bit hashes of its long lines, which are counted before and after the shuffle.
Lines that enough documents hold are indexed: a minimal perfect hash over the first 64 bits gives a place in compact
arrays of fingerprints (the other 64 bits), document counts and largest document ids. Documents probe these arrays.

The index has shards by hash, and the probes of one shard form one group. A line that would make a group large alone
(more than one in 4,096 of all line occurrences, so at most 4,096 lines) goes to a head index instead, whose size that
bound proves small; it is broadcast and probed in place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, pieces_of, small_batches, written
from .perfecthash import PerfectHash

STRIPPED = " \t\n\x0b\x0c\r"
SMALL = bytes.maketrans(UPPER.encode(), LOWER.encode())
MIN_CHARS, MIN_DOCS, HEAD_PARTS, SHARD_ROWS = 40, 5, 4096, 60_000
#: The id that stands for null: it sorts below all others.
NO_ID = -(2 ** 63)


def line_hashes(text: str | None, min_chars: int) -> tuple[list[str], list[bytes | None]]:
    """The lines of a text, and a 16-byte hash of each key that is long enough."""
    lines = (text or "").split("\n")
    hashes: list[bytes | None] = []
    for line in lines:
        key = line.strip(STRIPPED) if len(line) >= min_chars else ""
        hashes.append(hashlib.blake2b(key.encode("utf-8", "surrogatepass").translate(SMALL), digest_size=16).digest()
                      if len(key) >= min_chars else None)
    return lines, hashes


class LineIndex:
    """Perfect hash with fingerprint, count and largest-id arrays."""

    def __init__(self, where: PerfectHash, fingerprints: np.ndarray, counts: np.ndarray, largest: np.ndarray):
        self.where, self.fingerprints, self.counts, self.largest = where, fingerprints, counts, largest

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray, n: np.ndarray, largest: np.ndarray) -> LineIndex:
        keys = a.astype(np.int64).view(np.uint64)
        where = PerfectHash.build(keys)
        at = where.index(keys)
        arrays = [np.empty(len(where), dtype=t) for t in ("<i8", "<u4", "<i8")]
        for array, values in zip(arrays, (b, np.minimum(n, 2 ** 32 - 1), largest)):
            array[at] = values
        return cls(where, *arrays)

    def place(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where the lines (a, b) stand in the arrays; -1 for lines that are not in the index."""
        if not len(self.where):
            return np.full(len(a), -1, dtype=np.int64)
        at = self.where.index(a.astype(np.int64).view(np.uint64))
        return np.where(self.fingerprints[np.maximum(at, 0)] == b, at, -1)

    def droppable(self, a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """True where the line is in the index and another document keeps it."""
        at = self.place(a, b)
        out = at >= 0
        out[out] = self.largest[at[out]] != doc[out]
        return out

    def dump(self) -> tuple[bytes, bytes, bytes, bytes]:
        return self.where.dump(), self.fingerprints.tobytes(), self.counts.tobytes(), self.largest.tobytes()

    @classmethod
    def load(cls, where: bytes, fingerprints: bytes, counts: bytes, largest: bytes) -> LineIndex:
        return cls(PerfectHash.load(where), np.frombuffer(fingerprints, "<i8"), np.frombuffer(counts, "<u4"),
                   np.frombuffer(largest, "<i8"))


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """One (a, b, doc) row for every distinct long line of a document."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = {h for h in line_hashes(text.as_py(), min_chars)[1] if h}
                found.extend(own)
                ids.extend([doc] * len(own))
            both = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(ids, pa.int64())], names=["a", "b", "doc"])

    return docs.mapInArrow(lines, "a long, b long, doc long")


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, carried: list[str] | None = None) -> DataFrame:
    """doc_id, text (kept lines), n_lines, n_dropped of every row of ``docs`` (doc_id, text), and its ``carried`` columns; others are ignored.

    Null or empty texts are one empty line. Rows are documents: repeated rows count each, and all rows with the largest
    id keep the line. A null id sorts below all others and stays null. Lines are compared whole; an empty table gives
    an empty result.
    """
    more = F.struct(*(carried or [F.lit(None).cast("int").alias("nothing")])).alias("_more")
    own = small_batches(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), "text", more)
    found = written(_occurrences(own.select("doc", "text"), min_chars))
    counted = written(found.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("doc").alias("largest"))
                      .filter(F.col("n") >= min_docs))
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    most = max(min_docs, total // HEAD_PARTS)
    head = counted.filter(F.col("n") > most).toPandas()  # HEAD_PARTS lines at most
    head_index = LineIndex.build(*(head[c].to_numpy(dtype=np.int64) for c in ("a", "b", "n", "largest")))
    shipped = docs.sparkSession.sparkContext.broadcast(head_index.dump())

    n_shards = pieces_of(total, SHARD_ROWS, 64)
    shard = F.pmod(F.col("a"), F.lit(n_shards)).alias("shard")

    def index(rows: pd.DataFrame) -> pd.DataFrame:
        built = LineIndex.build(*(rows[c].to_numpy(dtype=np.int64) for c in ("a", "b", "n", "largest")))
        return pd.DataFrame([(rows["shard"].iloc[0], *built.dump())],
                            columns=["shard", "place", "fingerprints", "counts", "largest"])

    shards = written(counted.filter(F.col("n") <= most).select(shard, "a", "b", "n", "largest").groupBy("shard").applyInPandas(
        index, "shard long, place binary, fingerprints binary, counts binary, largest binary"))

    def not_in_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_index = LineIndex.load(*shipped.value)
        for batch in batches:
            yield batch.filter(pa.array(head_index.place(batch.column(0).to_numpy(), batch.column(1).to_numpy()) < 0))

    def probe(probes: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if shard.empty or probes.empty:
            return probes.iloc[:0][["doc", "a"]]
        row = shard.iloc[0]
        held = LineIndex.load(row["place"], row["fingerprints"], row["counts"], row["largest"])
        drop = held.droppable(probes["a"].to_numpy(), probes["b"].to_numpy(), probes["doc"].to_numpy())
        return probes.loc[drop, ["doc", "a"]]

    probes = found.mapInArrow(not_in_head, "a long, b long, doc long").select(shard, "a", "b", "doc")
    dropped = (probes.groupBy("shard").cogroup(shards.groupBy("shard"))
               .applyInPandas(probe, "doc long, a long")
               .groupBy("doc").agg(F.collect_set("a").alias("gone")))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_index = LineIndex.load(*shipped.value)
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for doc, text, gone in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(3).to_pylist()):
                lines, hashes = line_hashes(text.as_py(), min_chars)
                at = [i for i, h in enumerate(hashes) if h]
                both = np.frombuffer(b"".join(hashes[i] for i in at), dtype="<i8").reshape(-1, 2)
                drop = head_index.droppable(both[:, 0], both[:, 1], np.full(len(at), doc))
                if gone:
                    drop |= np.isin(both[:, 0], gone)
                out = {at[i] for i in np.flatnonzero(drop)}
                kept.append("\n".join(x for i, x in enumerate(lines) if i not in out))
                n_lines.append(len(lines))
                n_dropped.append(len(out))
            ids = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=ids == NO_ID), pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()),
                 pa.array(n_dropped, pa.int64()), batch.column(2)], names=["doc_id", "text", "n_lines", "n_dropped", "_more"])

    kind = own.select("_more").schema["_more"].dataType.simpleString()
    kept = own.join(dropped, "doc", "left").select("doc", "text", "_more", "gone").mapInArrow(
        keep, f"doc_id long, text string, n_lines long, n_dropped long, _more {kind}")
    return kept.select("doc_id", "text", "n_lines", "n_dropped", *[F.col("_more")[c].alias(c) for c in carried or []])
