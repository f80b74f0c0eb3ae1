"""Exact nearest neighbours over Spark partitions, and minority oversampling built on them.

Points go to the nearest of a fixed number of pivots. The farthest a neighbour can be follows from the
pivots' counts and radii, so a point is only compared with the cells it could matter to (triangle
inequality). Adjacent small cells are searched as one group, so that a point which matters to most cells is
not copied for each of them. Groups are cut into blocks; every pair of blocks keeps its k best candidates per
point and the blocks' lists are merged, so no task sees a whole crowded cell. Workers hold a bounded number of
distances at a time. Of equal vectors only k + 1 take part in the search; the other copies have those as
neighbours at distance 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .prefix import hash_numbered
from .sampling import sample_n


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a ** 2).sum(1)[:, None] + (b ** 2).sum(1)[None, :] - 2 * a @ b.T, 0.0))


#: Distances that a worker holds at once.
HELD_DISTANCES = 2_000_000


def slices(rows: int, width: int) -> list[slice]:
    """``rows`` cut so that a slice has ``HELD_DISTANCES`` distances to ``width`` points, and one row at least."""
    step = max(1, HELD_DISTANCES // max(width, 1))
    return [slice(low, low + step) for low in range(0, rows, step)]


def cell_groups(centers: np.ndarray, counts: np.ndarray, rows: int) -> list[np.ndarray]:
    """Occupied cells, halved at the median of the widest dimension until a group has ``rows`` points or is one cell."""
    todo, done = [np.flatnonzero(counts)], []
    while todo:
        cells = todo.pop()
        if len(cells) < 2 or counts[cells].sum() <= rows:
            done.append(cells)
            continue
        held = centers[cells]
        cells = cells[np.argsort(held[:, (held.max(0) - held.min(0)).argmax()], kind="stable")]
        todo += [cells[:len(cells) // 2], cells[len(cells) // 2:]]
    return done


def k_smallest(d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` smallest finite values of each row, of equal ones the first."""
    k = min(k, d.shape[1])
    row, column = np.nonzero((d <= np.partition(d, k - 1, 1)[:, k - 1:k]) & np.isfinite(d))
    order = np.lexsort((column, d[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def reach_per_cell(gaps: np.ndarray, counts: np.ndarray, radii: np.ndarray, k: int) -> np.ndarray:
    """Upper bound on the distance from any point of a cell to its k-th neighbour."""
    reach = np.full(len(counts), np.inf)
    for i in np.flatnonzero(counts):
        bound = np.where(counts > 0, gaps[i] + radii[i] + radii, np.inf)
        order = np.argsort(bound)
        enough = np.flatnonzero(np.cumsum(counts[order]) >= k + 1)
        if len(enough):
            reach[i] = bound[order[enough[0]]]
    return reach


def nearest(df: DataFrame, id_col: str, vector: str, k: int = 5, pivots: int | None = None, block_rows: int = 16_000) -> DataFrame:
    """The ``k`` nearest other points of every point: id, neighbour, distance, rank from 1.

    By default there are about as many pivots as the square root of the points, at most 4096.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    marked = rows.withColumn("copy", F.md5(F.col("v").cast("string")))
    ranked = cut_lineage(hash_numbered(marked, ["copy"], "id", 7, "n"))
    searched = ranked.filter(F.col("n") <= k + 1)
    found = search(searched.select("id", "v"), k, pivots, block_rows)
    beside = searched.filter(F.col("n") <= k).select("copy", F.col("id").alias("neighbor"), F.col("n").cast("int").alias("rank"))
    spare = ranked.filter(F.col("n") > k + 1).select("id", "copy").join(beside, "copy").select(
        "id", "neighbor", F.lit(0.0).alias("distance"), "rank")
    return found.unionByName(spare).withColumnRenamed("id", id_col)


def search(points: DataFrame, k: int, pivots: int | None, block_rows: int) -> DataFrame:
    """Nearest neighbours of a table (id, v) without large groups of equal vectors."""
    pivots = pivots or min(4096, max(16, int(points.count() ** 0.5)))
    centers = np.array([r["v"] for r in sample_n(points, "id", pivots, seed=7).select("v").collect()])
    if not len(centers):
        return points.limit(0).select("id", F.col("id").alias("neighbor"), F.lit(0.0).alias("distance"), F.lit(0).alias("rank"))

    def assign(batches):
        for pdf in batches:
            for part in slices(len(pdf), len(centers)):
                d = distances(np.stack(pdf["v"].iloc[part].to_numpy()), centers)
                yield pdf.iloc[part].assign(cell=d.argmin(1), d=d.min(1))

    id_type = dict(points.dtypes)["id"]
    placed = cut_lineage(points.mapInPandas(assign, f"id {id_type}, v array<double>, cell long, d double"))
    facts = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("radius")).collect()
    counts, radii = np.zeros(len(centers)), np.zeros(len(centers))
    for r in facts:
        counts[r["cell"]], radii[r["cell"]] = r["n"], r["radius"]
    reach = reach_per_cell(distances(centers, centers), counts, radii, k)
    groups = cell_groups(centers, counts, block_rows)
    ordered, firsts = np.concatenate(groups), np.cumsum([0, *map(len, groups)])[:-1]
    group_of = np.zeros(len(centers), dtype=np.int64)
    for i, cells in enumerate(groups):
        group_of[cells] = i

    def wanted(pdf):
        """Slices of the points, each with the places of its points that matter to a group, and the groups."""
        for part in slices(len(pdf), len(centers)):
            d = distances(np.stack(pdf["v"].iloc[part].to_numpy()), centers)[:, ordered]
            near = d - radii[None, ordered] <= reach[None, ordered] * (1 + 1e-9) + 1e-9
            yield pdf.iloc[part], *np.nonzero(np.logical_or.reduceat(near, firsts, 1))

    def count(batches):
        for pdf in batches:
            n = sum(np.bincount(group, minlength=len(groups)) for _, _, group in wanted(pdf))
            yield pd.DataFrame({"cell": np.arange(len(groups)), "n": n})

    def route(batches):
        for pdf in batches:
            for part, row, group in wanted(pdf):
                for cut in slices(len(row), part["v"].iloc[0].size):
                    yield pd.DataFrame({"id": part["id"].to_numpy()[row[cut]], "v": part["v"].to_numpy()[row[cut]], "cell": group[cut]})

    # The answers are too many to be written: they are counted first, without their vectors.
    asked = [int(counts[cells].sum()) for cells in groups]
    answered = {r["cell"]: r["n"] for r in placed.select("v").mapInPandas(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    blocks = F.broadcast(points.sparkSession.createDataFrame(
        [(i, -(-n // block_rows), -(-answered[i] // block_rows)) for i, n in enumerate(asked)], "cell long, qbs long, cbs long"))
    group = F.element_at(F.lit(group_of.tolist()).cast("array<long>"), F.col("cell").cast("int") + 1)
    in_block = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    each_block = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asks = placed.select("id", "v", group.alias("cell")).join(blocks, "cell").select(
        "cell", in_block("qbs").alias("qb"), each_block("cbs").alias("cb"), "id", "v", F.lit(True).alias("asks"))
    answers = placed.select("id", "v").mapInPandas(route, f"id {id_type}, v array<double>, cell long").join(blocks, "cell").select(
        "cell", each_block("qbs").alias("qb"), in_block("cbs").alias("cb"), "id", "v", F.lit(False).alias("asks"))

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        q, c = pdf[pdf["asks"]].sort_values("id"), pdf[~pdf["asks"]].sort_values("id")
        if q.empty or c.empty:
            return pd.DataFrame({"id": [], "neighbor": [], "distance": []})
        codes = pd.factorize(np.concatenate([q["id"].to_numpy(), c["id"].to_numpy()]))[0]
        own, other, found = codes[:len(q)], codes[len(q):], []
        points, held = np.stack(q["v"].to_numpy()), np.stack(c["v"].to_numpy())
        for part in slices(len(q), len(c)):
            d = distances(points[part], held)
            d[own[part][:, None] == other[None, :]] = np.inf
            row, column = k_smallest(d, k)
            found.append(pd.DataFrame({"id": q["id"].to_numpy()[part][row], "neighbor": c["id"].to_numpy()[column], "distance": d[row, column]}))
        return pd.concat(found)

    lists = asks.unionByName(answers).groupBy("cell", "qb", "cb").applyInPandas(
        best, f"id {id_type}, neighbor {id_type}, distance double")
    merged = lists.groupBy("id").agg(F.slice(F.array_sort(F.collect_list(F.struct("distance", "neighbor"))), 1, k).alias("l"))
    return merged.select("id", F.posexplode("l").alias("rank", "n")).select(
        "id", F.col("n.neighbor").alias("neighbor"), F.col("n.distance").alias("distance"), (F.col("rank") + 1).alias("rank"))


def smote(df: DataFrame, id_col: str, vector: str, label: str, k: int = 5, seed: int = 42,
          pivots: int | None = None) -> DataFrame:
    """Oversample the smaller class to the size of the larger one.

    New rows lie between a minority row and one of its ``k`` nearest minority rows; which one, and how far
    along, comes from a hash of the row and the copy number.
    """
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    small, large = min(counts, key=counts.get), max(counts, key=counts.get)
    need, have = counts[large] - counts[small], counts[small]
    given = df.select(F.col(id_col).cast("string").alias(id_col), F.col(vector).cast("array<double>").alias(vector), label,
                      F.lit(False).alias("synthetic"))
    if not need:
        return given
    minority = cut_lineage(df.filter(F.col(label) == small).select(id_col, F.col(vector).cast("array<double>").alias(vector)))
    links = nearest(minority, id_col, vector, k, pivots)
    degree = links.groupBy(id_col).agg(F.count("*").alias("_k"))
    copies = F.floor((need - F.col("_rank")) / have)
    bases = (hash_numbered(minority, [], id_col, seed, "_rank").filter(F.col("_rank") <= need).join(degree, id_col)
             .withColumn("copy", F.explode(F.sequence(F.lit(0), copies.cast("int")))))
    unit = lambda salt: F.conv(F.substring(F.md5(F.concat_ws(
        "|", F.col(id_col).cast("string"), F.col("copy"), F.lit(f"{salt}{seed}"))), 1, 8), 16, 10).cast("double") / 2.0 ** 32
    bases = bases.withColumn("rank", (F.floor(unit("n") * F.col("_k")) + 1).cast("int")).withColumn("_u", unit("u"))
    other = minority.select(F.col(id_col).alias("neighbor"), F.col(vector).alias("_other"))
    made = bases.join(links, [id_col, "rank"]).join(other, "neighbor")
    between = F.transform(F.arrays_zip(F.col(vector).alias("a"), F.col("_other").alias("b")),
                          lambda z: z["a"] + F.col("_u") * (z["b"] - z["a"]))
    rows = made.select(F.concat_ws("#", F.col(id_col).cast("string"), "copy").alias(id_col), between.alias(vector),
                       F.lit(small).alias(label), F.lit(True).alias("synthetic"))
    return given.unionByName(rows)
