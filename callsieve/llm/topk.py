"""Exact inner-product search by distributed histogram selection.

Vectors are packed into blocks; every block of queries meets every block of candidates in a task of its own, which scores all its pairs by one
matrix product. The k-th largest score of each query is located without moving scores: all scores fall in a range known
from the largest norms, each pass counts them in 256 bins of the range still open per query, sums the counts over all blocks, and
goes on with the bin that holds the k-th. Once bins are one score wide, a last pass lets through what is
above the k-th score and, of its ties, the smallest ids of each block. A block sends only the bins from the top down to its own
k-th score, since lower ones cannot hold the global k-th.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pieces_of, written

CANDIDATE_ROWS, QUERY_ROWS, BINS = 4096, 512, 256


def whole(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(id, v) of ``vectors`` (id, x): v is floor(scale * x); vectors that are null or hold null or non-finite parts go, repeats too."""
    fine = F.forall("x", lambda e: F.coalesce(F.abs(e.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(e))
    return (vectors.filter(F.col("x").isNotNull() & F.col("id").isNotNull()).filter(fine)
            .select(F.col("id").cast("long").alias("id"), F.transform("x", lambda e: F.floor(e.cast("double") * scale)).alias("v"))
            .dropDuplicates())


def _blocks(rows: DataFrame, each: int, dims: int, name: str) -> tuple[DataFrame, int]:
    """Blocks of about ``each`` rows: number, ids and matrix as bytes. Ids ascend; short vectors are filled with zeros."""
    n = pieces_of(rows.count(), each)

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("id", kind="stable")
        matrix = np.zeros((len(block), dims), dtype="<i8")
        for i, v in enumerate(block["v"]):
            matrix[i, :len(v)] = v
        return pd.DataFrame({name: [block[name].iloc[0]], f"{name}_ids": [block["id"].to_numpy("<i8").tobytes()], f"{name}_rows": [matrix.tobytes()]})

    packed = (rows.withColumn(name, F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("long")).groupBy(name)
              .applyInPandas(pack, f"{name} long, {name}_ids binary, {name}_rows binary"))
    return written(packed), n


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products; the float product is exact when nothing reaches 2**53."""
    if int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * max(q.shape[1], 1) < 2 ** 53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return q @ c.T


def _pairs(batch: pa.RecordBatch, dims: int) -> Iterator[tuple]:
    """For each pair of blocks: block number of the queries, their ids, candidate ids, scores, own-row mask, and state."""
    for row in batch.to_pylist():
        q_ids, c_ids = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["c_ids"], "<i8")
        scores = _scores(np.frombuffer(row["q_rows"], "<i8").reshape(-1, dims), np.frombuffer(row["c_rows"], "<i8").reshape(-1, dims))
        state = np.array([(s["low"], s["need"]) for s in row["state"]], dtype=np.int64).reshape(-1, 2)
        yield row["q"], q_ids, c_ids, scores, q_ids[:, None] == c_ids[None, :], state[:, :1], state[:, 1]


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` candidates of highest integer inner product per query, ties to the smaller id: query_id, rank, vec_id, score.

    Both inputs are (id, v) with v an array of longs. A candidate with the query's own id is no candidate; a query with
    fewer candidates gets all. Repeated equal rows count once. Vectors of unequal length count as filled up with zeros.
    Without queries or candidates the result is empty.
    """
    def facts(rows: DataFrame) -> tuple[int, float]:
        square = F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
        return tuple(rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(square), F.lit(0.0))).first())

    candidates, queries = written(candidates), written(queries)
    (c_dims, c_most), (q_dims, q_most) = facts(candidates), facts(queries)
    dims = max(c_dims, q_dims, 1)
    c_blocks, n_c = _blocks(candidates, CANDIDATE_ROWS, dims, "c")
    q_blocks, n_q = _blocks(queries, QUERY_ROWS, dims, "q")
    reach = int(np.sqrt(c_most) * np.sqrt(q_most)) + 2  # Cauchy-Schwarz
    every_c = c_blocks.withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_q - 1).cast("long"))))
    every_q = q_blocks.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_c - 1).cast("long"))))
    n_in_block = (F.length("q_ids") / 8).cast("int")
    width = 1
    while width * BINS < 2 * reach + 1:
        width *= BINS
    start = F.struct(F.lit(-reach).cast("long").alias("low"), F.lit(k).cast("long").alias("need"))
    state = q_blocks.select("q", F.array_repeat(start, n_in_block).alias("state"))

    def meet(state: DataFrame) -> DataFrame:
        return every_q.join(state, "q").join(every_c, ["q", "c"]).select("q", "q_ids", "q_rows", "c_ids", "c_rows", "state")

    while True:
        def count(batches: Iterator[pa.RecordBatch], width: int = width) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for q, q_ids, _, scores, own, low, need in _pairs(batch, dims):
                    at = (scores - low) // width
                    fits = (at >= 0) & (at < BINS) & ~own
                    flat = (np.arange(len(q_ids))[:, None] * BINS + at)[fits]
                    bins = np.bincount(flat, minlength=len(q_ids) * BINS).reshape(-1, BINS)
                    above = np.cumsum(bins[:, ::-1], axis=1)[:, ::-1] - bins
                    row, col = np.nonzero((bins > 0) & (above < need[:, None]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), q)), pa.array(row), pa.array(col), pa.array(bins[row, col])], names=["q", "i", "bin", "n"])

        bins = meet(state).mapInArrow(count, "q long, i long, bin long, n long").groupBy("q", "i", "bin").agg(F.sum("n").alias("n"))
        before = q_blocks.join(state, "q").select("q", F.posexplode("state").alias("i", "s")).select("q", F.col("i").cast("long").alias("i"), "s.low", "s.need")
        down = Window.partitionBy("q", "i").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        found = (bins.withColumn("through", F.sum("n").over(down)).join(before, ["q", "i"])
                 .filter((F.col("through") >= F.col("need")) & (F.col("through") - F.col("n") < F.col("need")))
                 .select("q", "i", (F.col("low") + F.col("bin") * width).alias("new_low"), (F.col("need") - F.col("through") + F.col("n")).alias("new_need")))
        # A query with too few candidates keeps its lowest bound, below every score, and takes all.
        after = before.join(found, ["q", "i"], "left").select(
            "q", "i", F.coalesce("new_low", F.lit(-reach)).alias("low"), F.coalesce("new_need", "need").alias("need"))
        state = written(after.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("i", "low", "need"))).alias("state"))
                        .select("q", F.transform("state", lambda s: F.struct(s["low"].alias("low"), s["need"].alias("need"))).alias("state")))
        if width == 1:
            break
        width //= BINS

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, q_ids, c_ids, scores, own, low, need in _pairs(batch, dims):
                ties = (scores == low) & ~own
                ties &= np.cumsum(ties, axis=1) <= need[:, None]  # candidate ids ascend
                row, col = np.nonzero(((scores > low) & ~own) | ties)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[row]), pa.array(c_ids[col]), pa.array(scores[row, col])],
                                                 names=["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (meet(state).mapInArrow(select, "query_id long, vec_id long, score long")
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
