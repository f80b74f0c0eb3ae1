"""Language of whole texts by nearest centroid.

A text is the L2-normalised TF-IDF vector of its hashed byte bigrams and trigrams. Document frequencies count every
training row. Each language is clustered into several centroids (spherical k-means on a bounded sample), and a text gets the
language of the centroid with the highest cosine. A centroid also keeps the smallest cosine of nearly all its own texts; a text that is
farther from its nearest centroid than that is marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

UNKNOWN = "und"
DIMS, CLUSTERS, ROUNDS, SLICE = 4096, 6, 8, 1 << 20
#: Rows that the centroids are fitted on, about, and the share of a centroid's texts that may lie beyond its radius.
SAMPLE_ROWS, BEYOND = 2000, 0.005
ASCII_LETTER = re.compile("[A-Za-z]")
#: Bytes as they count: letters and all non-ASCII bytes as they are, anything else as a space.
PLAIN = np.where((np.arange(256) >= 128) | ((np.arange(256) >= 97) & (np.arange(256) <= 122)), np.arange(256), 32).astype(np.uint32)


def has_letter(text: str | None) -> bool:
    return bool(text) and (ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def counts(text: str) -> np.ndarray:
    """Counts of hashed bigrams and trigrams of the text's letters (small, as UTF-8 bytes; one space between words), slice by slice."""
    held = PLAIN[np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)]
    held = held[(held != 32) | (np.roll(held, 1) != 32)]
    out = np.zeros(DIMS, dtype=np.float32)
    for start in range(0, max(len(held) - 1, 1), SLICE):
        a = held[start:start + SLICE + 2]
        two = a[:-1] * np.uint32(0x9E3779B1) + a[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] * np.uint32(0xC2B2AE3D) + a[2:] * np.uint32(0x27D4EB2F)
        for codes in (two[:SLICE], three[:SLICE]):
            out += np.bincount((codes ^ (codes >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(20), minlength=DIMS)
    return out


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    out = np.zeros((len(texts), DIMS), dtype=np.float32)
    for i, text in enumerate(texts):
        out[i] = counts(text)
    np.log1p(out, out=out)
    out *= idf
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norms > 0, norms, 1)


def clusters(rows: np.ndarray, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and their least cosine; starts are spread by taking the row farthest from those chosen."""
    chosen = [rows.mean(axis=0)]
    for _ in range(min(k, len(rows)) - 1):
        chosen.append(rows[np.argmin((rows @ np.array(chosen).T).max(axis=1))])
    centres = np.array(chosen)
    for _ in range(rounds):
        near = (rows @ centres.T).argmax(axis=1)
        sums = np.array([rows[near == j].sum(axis=0) if (near == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    cosine = rows @ centres.T
    near = cosine.argmax(axis=1)
    radius = np.array([np.quantile(cosine[near == j, j], BEYOND) if (near == j).any() else 1.0 for j in range(len(centres))])
    return centres, radius


class Model:
    """Centroids by language; plain arrays, so that it travels to the tasks."""

    def __init__(self, idf: np.ndarray, languages: list[str], centres: np.ndarray, radius: np.ndarray):
        self.idf, self.languages, self.centres, self.radius = idf, languages, centres, radius

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine (0 to 1) and whether the text lies beyond the centroid's radius."""
        languages, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        at = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        if at:
            cosine = vectors([texts[i] for i in at], self.idf) @ self.centres.T
            best = cosine.argmax(axis=1)
            for i, b, c in zip(at, best, cosine.max(axis=1)):
                languages[i], score[i], rejected[i] = self.languages[b], min(1.0, max(0.0, float(c))), c < self.radius[b]
        return languages, score, rejected


def fit(training: DataFrame, text: str = "text", lang: str = "lang", k: int = CLUSTERS, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model from labelled texts; rows without a label or a letter are left out.

    Document frequencies cover all rows. The centroids are fitted on about ``sample_rows`` rows, shared evenly among the languages
    and chosen by a hash of the text.
    """
    rows = training.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMS, dtype=np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                df += counts(value.as_py()) > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([*range(DIMS), -1]), pa.array([*df.tolist(), n])], names=["dim", "n"])

    df, n = np.zeros(DIMS), 0
    for r in rows.select("text").mapInArrow(frequencies, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect():
        if r["dim"] < 0:
            n = r["n"]
        else:
            df[r["dim"]] = r["n"]
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    sizes = rows.groupBy("lang").count()
    kept = F.col("count") * sizes.count() * (F.xxhash64("text") / 2.0 ** 64 + 0.5) < sample_rows
    # One row per language: far smaller than the centroids, which go to every task as well.
    sample = rows.join(F.broadcast(sizes), "lang").filter(kept).select("lang", "text")

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        centres, radius = clusters(vectors(group["text"].tolist(), idf), k, ROUNDS)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "part": range(len(centres)), "centre": [c.astype("<f4").tobytes() for c in centres],
                             "radius": radius})

    found = sample.groupBy("lang").applyInPandas(fitted, "lang string, part int, centre binary, radius double").orderBy("lang", "part").collect()
    centres = np.array([np.frombuffer(r["centre"], "<f4") for r in found], dtype=np.float32).reshape(-1, DIMS)
    return Model(idf, [r["lang"] for r in found], centres, np.array([r["radius"] for r in found]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def identified(docs: DataFrame, k: int = CLUSTERS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every row of ``docs`` (doc_id, text, lang; others are ignored).

    Learned from the rows that are not held out (a null id is not). Texts that are null or without a letter get ``und``, score 0 and
    are rejected; so do all texts when nothing could be learned. Whole texts are read; repeated rows are scored
    each; an empty table gives an empty result.
    """
    own = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    shipped = docs.sparkSession.sparkContext.broadcast(fit(own.filter("not held_out"), k=k, sample_rows=sample_rows))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                languages, score, rejected = model.predict(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(languages, pa.string()), pa.array(score), pa.array(rejected)],
                    names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return own.select("doc_id", "held_out", "text").mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
