"""Toxic spans and document scores from a linear-chain conditional random field.

The labels say which documents are toxic, not which words. Words, and word starts of four to seven letters, that hardly occur outside
toxic documents give each token an evidence level; tokens of other toxic documents with strong evidence are the labelled
tokens. A two-state chain (clean, toxic) with an emission weight per evidence level, transitions and a start weight is
fitted to them by gradient ascent. Forward-backward marginals then score every token of every whole text: a
document's score is the chance that any token is toxic, taking the marginals as independent and leaving out tiny ones, and its spans are runs of
tokens whose marginal is at least one half.

The two recursions run over all documents of a batch at once: tokens stand in blocks of 64, blocks are multiplied to 2 x 2 matrices, the
matrices are chained per document, and the vectors at block borders then give all positions inside.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .shingles import slices

WORD = re.compile(r"[^\W\d_]+")
STARTS = (4, 5, 6, 7)
#: Evidence levels: log-odds from each of these bounds on; below is level 0. Tokens from STRONG on are labelled toxic.
BOUNDS, STRONG = (1.0, 2.0, 3.0, 4.0, 5.0, 6.0), 3
LEVELS = len(BOUNDS) + 1
BLOCK, BATCH_TOKENS, MOST_WORDS = 64, 400_000, 200_000
#: Bounds of the sample that evidence is counted on (documents), and of the one that the chain is fitted on.
EVIDENCE_ROWS, FIT_ROWS, FIT_TOKENS = 12_000, 1500, 3000
ROUNDS, PRIOR, SURE = 60, 0.5, 0.5
#: Marginals below this do not count, or a long text would be toxic for its length.
LEAST = 0.01


class Chain:
    """Weights of the field: emission (level), transition (from, to) and start, of state 1 against state 0."""

    def __init__(self, emission: np.ndarray, transition: np.ndarray, start: float):
        self.emission, self.transition, self.start = emission, transition, start

    def marginals(self, levels: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chance of state 1 per token, and of (state, next state) summed per pair kind, for sequences laid end to end."""
        n_blocks = -(-lengths // BLOCK)
        first_block = np.concatenate([[0], np.cumsum(n_blocks)])
        total = int(first_block[-1])
        if not total:
            return np.zeros(0), np.zeros((2, 2))
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        inner = np.arange(len(levels)) - np.repeat(starts, lengths)
        place = np.repeat(first_block[:-1] * BLOCK, lengths) + inner
        real = np.zeros(total * BLOCK, dtype=bool)
        real[place] = True
        real = real.reshape(total, BLOCK)
        ratio = np.ones(total * BLOCK)
        ratio[place] = np.exp(self.emission)[levels]
        ratio = ratio.reshape(total, BLOCK)
        t = np.exp(self.transition)
        opening = np.array([1.0, np.exp(self.start)])
        # Block matrices, scaled step by step; filler positions at a document's end leave them as they are.
        p = np.zeros((total, 2, 2))
        p[:, 0, 0] = p[:, 1, 1] = 1
        is_first = np.zeros(total, dtype=bool)
        is_first[first_block[:-1][n_blocks > 0]] = True
        for i in range(BLOCK):
            q = np.empty_like(p)
            q[:, :, 0] = p[:, :, 0] * t[0, 0] + p[:, :, 1] * t[1, 0]
            q[:, :, 1] = (p[:, :, 0] * t[0, 1] + p[:, :, 1] * t[1, 1]) * ratio[:, i, None]
            if i == 0:  # a document's first token has no transition before it
                q[is_first, :, 0] = p[is_first, :, 0]
                q[is_first, :, 1] = p[is_first, :, 1] * ratio[is_first, 0, None]
            q /= q.sum(axis=(1, 2), keepdims=True)
            p = np.where(real[:, i, None, None], q, p)
        alpha, beta = np.empty((total, 2)), np.empty((total, 2))
        owners = np.flatnonzero(n_blocks > 0)
        alpha[first_block[owners]] = opening / opening.sum()
        step = 1
        while len(active := owners[n_blocks[owners] > step]):
            at = first_block[active] + step
            v = np.einsum("bi,bij->bj", alpha[at - 1], p[at - 1])
            alpha[at] = v / v.sum(axis=1, keepdims=True)
            step += 1
        last = first_block[owners] + n_blocks[owners] - 1
        beta[last] = 0.5
        step = 1
        while len(active := owners[n_blocks[owners] > step]):
            at = first_block[active] + n_blocks[active] - 1 - step
            v = np.einsum("bij,bj->bi", p[at + 1], beta[at + 1])
            beta[at] = v / v.sum(axis=1, keepdims=True)
            step += 1
        forward = np.empty((BLOCK, total, 2))
        v = alpha
        for i in range(BLOCK):
            w = np.empty_like(v)
            w[:, 0] = v[:, 0] * t[0, 0] + v[:, 1] * t[1, 0]
            w[:, 1] = (v[:, 0] * t[0, 1] + v[:, 1] * t[1, 1]) * ratio[:, i]
            if i == 0:
                w[is_first, 0] = v[is_first, 0]
                w[is_first, 1] = v[is_first, 1] * ratio[is_first, 0]
            w /= w.sum(axis=1, keepdims=True)
            v = np.where(real[:, i, None], w, v)
            forward[i] = v
        chance = np.empty((total, BLOCK))
        pairs = np.zeros((2, 2))
        v = beta
        for i in range(BLOCK - 1, -1, -1):
            both = forward[i] * v
            chance[:, i] = both[:, 1] / both.sum(axis=1)
            after = np.stack([v[:, 0], v[:, 1] * ratio[:, i]], axis=1)
            before = forward[i - 1] if i else alpha
            joint = before[:, :, None] * t[None] * after[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            counted = real[:, i] & (~is_first if i == 0 else True)
            pairs += joint[counted].sum(axis=0)
            w = np.stack([t[0, 0] * after[:, 0] + t[0, 1] * after[:, 1], t[1, 0] * after[:, 0] + t[1, 1] * after[:, 1]], axis=1)
            w /= w.sum(axis=1, keepdims=True)
            v = np.where(real[:, i, None], w, v)
        return chance.reshape(-1)[place], pairs

    @classmethod
    def fit(cls, levels: np.ndarray, states: np.ndarray, lengths: np.ndarray, rounds: int = ROUNDS) -> Chain:
        """Gradient ascent (signs, with a step of its own per weight) on the log-likelihood with a normal prior."""
        firsts = np.concatenate([[0], np.cumsum(lengths)])[:-1][lengths > 0].astype(np.int64)
        inside = np.ones(len(levels), dtype=bool)
        inside[firsts] = False
        seen_pairs = np.zeros((2, 2))
        at = np.flatnonzero(inside)
        np.add.at(seen_pairs, (states[at - 1], states[at]), 1)
        seen = np.bincount(levels, weights=states, minlength=LEVELS)
        weights, steps, last = np.zeros(LEVELS + 5), np.full(LEVELS + 5, 0.5), np.zeros(LEVELS + 5)
        for _ in range(rounds):
            chain = cls(weights[:LEVELS], weights[LEVELS:LEVELS + 4].reshape(2, 2), weights[-1])
            chance, pairs = chain.marginals(levels, lengths)
            slope = np.concatenate([seen - np.bincount(levels, weights=chance, minlength=LEVELS), (seen_pairs - pairs).ravel(),
                                    [states[firsts].sum() - chance[firsts].sum()]]) - PRIOR * weights
            same = np.sign(slope) * last
            steps = np.clip(np.where(same > 0, steps * 1.2, np.where(same < 0, steps * 0.5, steps)), 1e-4, 2)
            weights = weights + np.sign(slope) * steps
            last = np.sign(slope)
        emission = weights[:LEVELS].copy()
        for level in range(1, LEVELS):  # a level without tokens is worth the one below
            if not (levels == level).any():
                emission[level] = emission[level - 1]
        return cls(emission, weights[LEVELS:LEVELS + 4].reshape(2, 2), weights[-1])


class Levels(dict):
    """Evidence level of a word as written; holds a bounded number of words."""

    def __init__(self, evidence: dict[str, int]):
        self.evidence = evidence

    def __missing__(self, word: str) -> int:
        level = max(self.evidence.get(f, 0) for f in features(word))
        if len(self) < MOST_WORDS and len(word) < 40:
            self[word] = level
        return level


def features(word: str) -> list[str]:
    small = word.lower()
    return [small, *(f"{small[:n]}*" for n in STARTS if len(small) > n)]


class Tagger:
    """Evidence and chain; plain data, so that it travels to the tasks."""

    def __init__(self, evidence: dict[str, int], chain: Chain):
        self.evidence, self.chain = evidence, chain
        self.levels = None

    def __getstate__(self) -> tuple:
        return self.evidence, self.chain

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def encode(self, text: str | None) -> bytes:
        if self.levels is None:
            self.levels = Levels(self.evidence)
        levels = self.levels
        return bytes([levels[w] for w in WORD.findall(text or "")])

    def tag(self, texts: list[str | None]) -> tuple[list[float], list[list[tuple[int, int]]]]:
        """Score and toxic spans (code points, end exclusive) of each text."""
        scores: list[float] = []
        spans: list[list[tuple[int, int]]] = []
        waiting: list[tuple[str | None, bytes]] = []

        def flush() -> None:
            lengths = np.array([len(b) for _, b in waiting], dtype=np.int64)
            chance, _ = self.chain.marginals(np.frombuffer(b"".join(b for _, b in waiting), dtype=np.uint8), lengths)
            ends = np.cumsum(lengths)
            counting = np.where(chance >= LEAST, np.minimum(chance, 1 - 1e-12), 0.0)
            clean = np.concatenate([[0.0], np.cumsum(np.log1p(-counting))])
            for (text, _), end, n in zip(waiting, ends, lengths):
                scores.append(float(max(0.0, -np.expm1(clean[end] - clean[end - n]))) + 0.0)
                toxic = np.flatnonzero(chance[end - n:end] >= 0.5)
                spans.append(_spans(text, toxic.tolist()) if len(toxic) else [])
            waiting.clear()

        held = 0
        for text in texts:
            waiting.append((text, self.encode(text)))
            held += len(waiting[-1][1])
            if held >= BATCH_TOKENS:
                flush()
                held = 0
        if waiting:
            flush()
        return scores, spans


def _spans(text: str, tokens: list[int]) -> list[tuple[int, int]]:
    """Offsets of the numbered words; neighbours are joined."""
    wanted, out, before = set(tokens), [], -2
    for i, m in enumerate(WORD.finditer(text)):
        if i in wanted:
            if i == before + 1:
                out[-1] = (out[-1][0], m.end())
            else:
                out.append((m.start(), m.end()))
            before = i
    return out


def surely(hits: int, n: int, z: float = 1.96) -> float:
    """Lower bound of the share behind ``hits`` of ``n`` (Wilson score)."""
    p = hits / n
    return (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def fit(docs: DataFrame, labels: DataFrame, evidence_rows: int = EVIDENCE_ROWS, fit_rows: int = FIT_ROWS) -> Tagger:
    """Tagger from texts and 0/1 labels of their documents.

    Evidence is counted on about ``evidence_rows`` labelled documents (three quarters at most), the chain is fitted on about ``fit_rows``
    others (a quarter at most), leaving out texts of more than ``FIT_TOKENS`` words; both are chosen by a hash of the id.
    """
    labelled = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = labelled.count()
    chance = F.xxhash64("doc_id") / 2.0 ** 64 + 0.5
    # At most about evidence_rows short rows, so that broadcasting them is safe.
    chosen = F.broadcast(labelled.filter(chance < min(evidence_rows / max(n, 1), 0.75)))
    others = F.broadcast(labelled.filter(chance >= 1 - min(fit_rows / max(n, 1), 0.25)))
    sample = docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "toxic")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for text in batch.column(0):
                words = WORD.findall(text.as_py() or "")
                keys.append(min((zlib.crc32(" ".join(words[i:i + 3]).encode()) for i in range(max(1, len(words) - 2)))))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *batch.columns], names=["key", "text", "toxic"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, toxic = Counter(), Counter()
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                found = {f for w in set(WORD.findall(text.as_py() or "")) for f in features(w)}
                found.add("")  # counts the documents themselves
                both.update(found)
                if label == 1:
                    toxic.update(found)
            yield pa.RecordBatch.from_arrays([pa.array(both.keys(), pa.string()), pa.array(both.values(), pa.int64()),
                                              pa.array([toxic[f] for f in both], pa.int64())], names=["feature", "n", "n_toxic"])

    # Of texts that share the smallest hash of their word triples, near copies mostly, one counts: else the words of a text with
    # many copies would look toxic.
    once = (sample.withColumn("toxic", F.col("toxic").cast("int")).mapInArrow(sketch, "key long, text string, toxic int")
            .groupBy("key").agg(F.min_by(F.struct("text", "toxic"), F.struct(F.xxhash64("text", "toxic"), "text")).alias("one")).select("one.*"))
    counted = (once.mapInArrow(count, "feature string, n long, n_toxic long").groupBy("feature")
               .agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic")))
    # Only features nearly bound to toxic documents come to the driver; a bounded sample holds a bounded number.
    kept = counted.filter("feature = '' or n_toxic >= 6 and n_toxic >= 0.5 * n").collect()
    all_docs, all_toxic = next(((r["n"], r["n_toxic"]) for r in kept if r["feature"] == ""), (0, 0))
    evidence = {}
    for r in kept:
        if r["feature"] and r["n_toxic"] >= 0.01 * all_toxic and surely(r["n_toxic"], r["n"]) >= SURE:
            odds = np.log((r["n_toxic"] + 0.5) / (all_toxic + 1)) - np.log((r["n"] - r["n_toxic"] + 0.5) / (all_docs - all_toxic + 1))
            evidence[r["feature"]] = int(np.searchsorted(BOUNDS, odds, side="right"))
    tagger = Tagger(evidence, Chain(np.zeros(LEVELS), np.zeros((2, 2)), 0.0))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = [tagger.encode(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(coded, pa.binary()), batch.column(1)], names=["levels", "toxic"])

    rows = (docs.select("doc_id", "text").join(others, "doc_id")
            .select("text", F.col("toxic").cast("int").alias("toxic"))
            .mapInArrow(encode, "levels binary, toxic int").filter(f"length(levels) between 1 and {FIT_TOKENS}").collect())
    rows.sort(key=lambda r: (bytes(r["levels"]), r["toxic"]))
    if rows:
        levels = np.frombuffer(b"".join(bytes(r["levels"]) for r in rows), dtype=np.uint8)
        lengths = np.array([len(r["levels"]) for r in rows], dtype=np.int64)
        states = ((levels >= STRONG) & (np.repeat([r["toxic"] for r in rows], lengths) == 1)).astype(np.int64)
        tagger.chain = Chain.fit(levels, states, lengths)
    else:
        tagger.chain = Chain(np.full(LEVELS, -50.0), np.zeros((2, 2)), 0.0)
    return tagger


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def tagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, lang, source, n_chars, held_out, score, predicted, spans of every row of ``docs`` (other columns are ignored).

    Learned from the labels of rows that are not held out. Null and empty texts have no tokens and score 0, as do all
    texts when no label could be learned from. Null ids are kept; repeated rows are scored each; repeated labels of
    a document count as toxic if one is; an empty table gives an empty result. Whole texts are read.
    """
    learned = small_batches(labels).filter(~held_out(F.col("doc_id")))
    shipped = docs.sparkSession.sparkContext.broadcast(fit(docs, learned))
    columns = "doc_id long, text string, lang string, source string, n_chars long, held_out boolean"
    own = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", "n_chars",
                      held_out(F.col("doc_id")).alias("held_out"))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = shipped.value
        for batch in batches:
            for part in slices(batch, 1):
                scores, spans = tagger.tag(part.column(1).to_pylist())
                scores = [round(float(s), 12) for s in scores]  # the last digits depend on which texts are tagged together
                out = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], kind)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), out],
                    names=[*part.schema.names, "score", "predicted", "spans"])

    return own.mapInArrow(tag, f"{columns}, score double, predicted int, spans array<struct<start: int, end: int>>")
