"""Repeated passages by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text; where its top bits are zero, and the chunk is long enough, a chunk ends. Cuts depend on
the last 32 bytes only, so an insertion shifts no later cut for long, and a passage is cut alike in all documents that hold it. Chunks are compared
by a 64-bit digest. Digests that more than one document holds are repeated; touching repeated chunks of a document form a span, and spans that are long enough are
reported. The document with the smallest id keeps a chunk; the other documents lose it where it is in a span. Digests are counted before the shuffle, and the join back leaves hot
digests to adaptive splitting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bytehash import Substrings
from .common import small_batches, written

LEAST, MOST, CUT_BITS, SPAN_BYTES, SLICE = 16, 256, 4, 120, 1 << 22
GEAR = np.random.default_rng(7).integers(0, 2 ** 32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: the sum of its last 32 bytes' numbers, shifted one bit per byte of age."""
    out = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        out[step:] = out[step:] + (out[:-step] << np.uint32(step))
    return out


def cuts(data: np.ndarray, least: int = LEAST, most: int = MOST, cut_bits: int = CUT_BITS) -> list[int]:
    """End of each chunk."""
    out, last = [], 0
    ends = (np.flatnonzero(gear(data) >> np.uint32(32 - cut_bits) == 0) + 1).tolist()
    ends.append(len(data))
    for end in ends:
        while end - last > most:
            last += most
            out.append(last)
        if end - last >= least:
            out.append(end)
            last = end
    if last < len(data):
        out.append(len(data))
    return out


def chunks(docs: DataFrame, least: int = LEAST, most: int = MOST, cut_bits: int = CUT_BITS) -> DataFrame:
    """doc_id, start, length (bytes) and digest of every chunk of every text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, lengths, digests, held = [], [], [], [], 0

            def out() -> pa.RecordBatch:
                parts = [np.concatenate(x) if x else np.zeros(0, dtype=t) for x, t in
                         ((ids, np.int64), (starts, np.int64), (lengths, np.int64), (digests, np.uint64))]
                return pa.RecordBatch.from_arrays(
                    [pa.array(parts[0]), pa.array(parts[1]), pa.array(parts[2].astype(np.int32)), pa.array(parts[3].view(np.int64))],
                    names=["doc_id", "start", "length", "digest"])

            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer((text.as_py() or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
                if doc_id is None or not len(data):
                    continue
                ends = np.array(cuts(data, least, most, cut_bits), dtype=np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                # Very long texts are hashed slice by slice: chunks are far shorter than a slice.
                for low in range(0, len(data), SLICE):
                    own = (begins >= low) & (begins < low + SLICE)
                    part = Substrings(data[low:low + SLICE + most])
                    digests.append(part.hashes(begins[own] - low, ends[own] - low))
                ids.append(np.full(len(ends), doc_id, dtype=np.int64))
                starts.append(begins)
                lengths.append(ends - begins)
                held += len(ends)
                if held > 500_000:
                    yield out()
                    for values in (ids, starts, lengths, digests):
                        values.clear()
                    held = 0
            yield out()

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, "doc_id long, start long, length int, digest long")


def low_bits(digest: str) -> Column:
    """32 bits of a digest; sums of them do not overflow."""
    return F.col(digest).bitwiseAND(F.lit(0xFFFFFFFF))


def passages(docs: DataFrame, span_bytes: int = SPAN_BYTES, cut: DataFrame | None = None) -> DataFrame:
    """The rows of :func:`spans` with ``gone``, the byte ranges (start, n) of a span whose chunks a document with a smaller id keeps, and
    ``gone_digest``, the sum of those chunks' digests. ``cut``: the chunks, where they are there already."""
    cut = written(chunks(docs)) if cut is None else cut
    repeated = (cut.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
                .filter("first <> last").select("digest", "first", "n"))
    held = cut.join(written(repeated), "digest").groupBy("doc_id", "start").agg(
        F.max("length").alias("length"), F.min("first").alias("first"), F.max("n").alias("n"), F.min("digest").alias("digest"))
    order = Window.partitionBy("doc_id").orderBy("start")
    dropped = F.col("first") < F.col("doc_id")
    opens = F.when(F.lag(F.col("start") + F.col("length")).over(order) == F.col("start"), 0).otherwise(1)
    turns = F.when((F.col("opens") == 0) & (F.lag(dropped).over(order) == dropped), 0).otherwise(1)
    numbered = (held.withColumn("opens", opens).withColumn("turns", turns)
                .withColumn("span", F.sum("opens").over(order)).withColumn("run", F.sum("turns").over(order)))
    # A run is a part of a span that is kept or dropped as a whole.
    runs = numbered.groupBy("doc_id", "span", "run").agg(
        F.min("start").alias("start"), F.sum("length").cast("long").alias("n"), F.bool_or(dropped).alias("dropped"), F.sum(low_bits("digest")).alias("digest"),
        F.count("*").alias("n_chunks"), F.max("n").alias("most_docs"), F.min("first").alias("first_doc_id"))
    return (runs.groupBy("doc_id", "span").agg(
        F.min("start").alias("start_byte"), F.sum("n").alias("n_bytes"),
        F.sum(F.when(F.col("dropped"), F.col("n")).otherwise(0)).alias("n_dropped_bytes"),
        F.sum("n_chunks").alias("n_chunks"), F.max("most_docs").alias("most_docs"), F.min("first_doc_id").alias("first_doc_id"),
        F.collect_list(F.when(F.col("dropped"), F.struct("start", "n"))).alias("gone"),
        F.sum(F.when(F.col("dropped"), F.col("digest")).otherwise(0)).alias("gone_digest"))
        .filter(F.col("n_bytes") >= span_bytes).drop("span"))


def spans(docs: DataFrame, span_bytes: int = SPAN_BYTES) -> DataFrame:
    """Repeated passages of ``docs`` (doc_id, text; other columns are ignored): doc_id, start_byte, n_bytes, n_dropped_bytes, n_chunks,
    most_docs and first_doc_id, one row per span of at least ``span_bytes`` bytes.

    n_dropped_bytes are those whose chunks a document with a smaller id keeps. Null and empty texts and null ids have no
    spans. Repeated rows of one id are one document; their spans fall together. An empty table gives an empty result.
    """
    return passages(docs, span_bytes).drop("gone", "gone_digest")


def without(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id and text of every row without the ranges that ``found``, the :func:`passages` of ``docs``, names."""
    gone = found.filter("n_dropped_bytes > 0").groupBy("doc_id").agg(F.flatten(F.collect_list("gone")).alias("gone"))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if text and ranges:
                    data, kept, at = text.encode("utf-8", "surrogatepass"), [], 0
                    for start, end in sorted((r["start"], r["start"] + r["n"]) for r in ranges):
                        # A character that is not whole inside the range stays: no other document need hold it.
                        while start < end and start < len(data) and data[start] & 0xC0 == 0x80:
                            start += 1
                        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
                            end -= 1
                        if start < end:
                            kept.append(data[at:start])
                            at = max(at, end)
                    text = b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    own = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.join(gone, "doc_id", "left").mapInArrow(drop, "doc_id long, text string")


def deduplicated(docs: DataFrame, span_bytes: int = SPAN_BYTES) -> DataFrame:
    """doc_id and text of every row without the chunks of its spans that a document with a smaller id keeps, cut at whole characters.

    The smallest id that holds a chunk always keeps it, so no text goes from all documents.
    """
    return without(docs, passages(docs, span_bytes))


def report(docs: DataFrame, span_bytes: int = SPAN_BYTES) -> DataFrame:
    """The spans, each with the length (kept_bytes) and the sum of the digests (kept_digest) of the chunks that its document keeps.

    No text is moved for that. Both are summed over repeated rows of one id, each of which loses what the document loses. Where a
    cut parts a character, :func:`deduplicated` keeps its bytes, which are not counted here.
    """
    cut = written(chunks(docs))
    found = written(passages(docs, span_bytes, cut))
    whole = cut.groupBy("doc_id").agg(F.sum("length").cast("long").alias("bytes"), F.sum(low_bits("digest")).alias("digest"), F.count_if(F.col("start") == 0).alias("rows"))
    lost = found.groupBy("doc_id").agg(F.sum("n_dropped_bytes").alias("lost_bytes"), F.sum("gone_digest").alias("lost_digest"))
    facts = lost.join(whole, "doc_id").select(
        "doc_id", (F.col("bytes") - F.col("rows") * F.col("lost_bytes")).alias("kept_bytes"), (F.col("digest") - F.col("rows") * F.col("lost_digest")).alias("kept_digest"))
    return found.drop("gone", "gone_digest").join(facts, "doc_id")
