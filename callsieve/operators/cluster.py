"""Density clustering on a grid, and cluster evaluation.

Points are put into cells whose diagonal equals ``eps``, so all points of one cell are neighbours. A cell
with ``min_points`` points makes them all core points, without looking at any pair. Only points of thinner
cells are compared, with the points of adjacent cells; there are fewer than ``min_points`` of them per cell.
Which occupied cells are adjacent is found in a partition of space by median cuts, with cells within reach of a
cut on both sides of it.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .prefix import numbered

#: Cells that one task compares with those around them.
LEAF_CELLS = 1000


def squared_distance(a: str, b: str, dims: int) -> Column:
    return reduce(add, [(F.col(f"{a}.x{i}") - F.col(f"{b}.x{i}")) * (F.col(f"{a}.x{i}") - F.col(f"{b}.x{i}")) for i in range(dims)])


def points_in_cells(df: DataFrame, id_col: str, columns: list[str], eps: float) -> DataFrame:
    """id, coordinates x0.., cell numbers c0.. and the cell key."""
    side = eps / math.sqrt(len(columns))
    rows = df.select(F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
                     *[F.floor(F.col(c) / side).alias(f"c{i}") for i, c in enumerate(columns)])
    return rows.withColumn("cell", F.concat_ws(",", *[F.col(f"c{i}") for i in range(len(columns))]))


def parted(cells: DataFrame, dims: int, leaf_cells: int) -> DataFrame:
    """Cells (cell, box: their numbers as an array) by ``leaf``: each is its own leaf's (``own``), and a copy in every leaf within reach.

    Leaves are halved at the median of their widest dimension until they are small enough. Cells within reach of the cut go to both sides. A
    leaf that is nowhere wide enough for a cut to part it stays, whatever its size; it is compared in blocks.
    """
    reach = math.isqrt(dims) + 1
    rows = cut_lineage(cells.select("cell", F.array(*[F.col(f"c{i}") for i in range(dims)]).alias("box"), F.lit(0).cast("long").alias("leaf"), F.lit(True).alias("own")))
    done = None
    while True:
        spans = [F.struct((F.max(F.col("box")[i]) - F.min(F.col("box")[i])).alias("span"), F.lit(i).alias("dim")) for i in range(dims)]
        widest = rows.filter("own").groupBy("leaf").agg(F.count("*").alias("n"), F.array_max(F.array(*spans)).alias("w"))
        open_leaves = widest.filter((F.col("n") > leaf_cells) & (F.col("w.span") > 4 * reach)).select("leaf", "w.dim")
        at = lambda df: df.withColumn("v", F.get("box", "dim"))
        middles = at(rows.filter("own").join(open_leaves, "leaf")).groupBy("leaf", "dim").agg(
            F.greatest(F.percentile_approx("v", 0.5), F.min("v") + 1).alias("cut"))
        middles = cut_lineage(middles)
        closed = rows.join(middles.select("leaf"), "leaf", "left_anti")
        done = closed if done is None else done.unionByName(closed)
        if middles.isEmpty():
            return done
        halves = at(rows.join(middles, "leaf"))
        low, high = F.col("v") < F.col("cut") + reach, F.col("v") >= F.col("cut") - reach
        side = lambda n, near, own: F.when(near, F.struct((F.col("leaf") * 2 + n).alias("leaf"), (F.col("own") & own).alias("own")))
        sides = F.filter(F.array(side(1, low, F.col("v") < F.col("cut")), side(2, high, F.col("v") >= F.col("cut"))), lambda x: x.isNotNull())
        rows = cut_lineage(halves.select("cell", "box", F.explode(sides).alias("s")).select("cell", "box", "s.leaf", "s.own"))


def adjacent_cells(cells: DataFrame, dims: int, leaf_cells: int | None = None) -> DataFrame:
    """Pairs of different occupied cells that may hold points within eps: their boxes are no further apart, in any number of dimensions."""
    leaf_cells = leaf_cells or LEAF_CELLS
    rows = cut_lineage(parted(cells, dims, leaf_cells))
    counts = rows.groupBy("leaf").agg(F.ceil(F.count_if("own") / leaf_cells).alias("owns"), F.ceil(F.count("*") / (4 * leaf_cells)).alias("alls"))
    blocked = rows.join(counts, "leaf").withColumns({"ob": F.pmod(F.xxhash64("cell"), F.col("owns")), "ab": F.pmod(F.xxhash64("cell"), F.col("alls"))})
    asking = blocked.filter("own").select("leaf", "ob", F.explode(F.sequence(F.lit(0).cast("long"), F.col("alls") - 1)).alias("ab"), "cell", "box", F.lit(True).alias("asks"))
    around = blocked.filter("owns > 0").select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("owns") - 1)).alias("ob"), "ab", "cell", "box", F.lit(False).alias("asks"))

    def near(pdf: pd.DataFrame) -> pd.DataFrame:
        asks, others = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        out = []
        if len(asks) and len(others):
            boxes = np.stack(others["box"].to_numpy())
            names = others["cell"].to_numpy()
            for cell, box in zip(asks["cell"], asks["box"]):
                # Box sides are eps / sqrt(dims): gaps up to dims squared sides are within eps.
                found = names[(np.maximum(np.abs(boxes - box) - 1, 0).astype(float) ** 2).sum(1) <= dims]
                out += [(cell, other) for other in found if other != cell]
        return pd.DataFrame(out, columns=["cell", "other"])

    return asking.unionByName(around).groupBy("leaf", "ob", "ab").applyInPandas(near, "cell string, other string")


def core_points(points: DataFrame, dims: int, eps: float, min_points: int) -> DataFrame:
    """Points with ``is_core``; the neighbour count includes the point itself."""
    cells = points.groupBy("cell", *[f"c{i}" for i in range(dims)]).agg(F.count("*").alias("n"))
    sizes = points.join(cells.select("cell", "n"), "cell")
    thin = cells.filter(F.col("n") < min_points)
    pairs = adjacent_cells(cells, dims).join(thin.select("cell"), "cell", "left_semi")
    # Points of adjacent cells travel to the thin cell, where fewer than min_points rows wait for each.
    around = points.select(F.col("cell").alias("other"), *[f"x{i}" for i in range(dims)]).join(pairs, "other")
    waiting = sizes.filter(F.col("n") < min_points)
    close = (waiting.alias("p").join(around.alias("q"), F.col("p.cell") == F.col("q.cell"))
             .filter(squared_distance("p", "q", dims) <= eps * eps).groupBy(F.col("p.id").alias("id")).agg(F.count("*").alias("m")))
    return sizes.join(close, "id", "left").select(
        *points.columns, ((F.col("n") >= min_points) | (F.col("n") + F.coalesce("m", F.lit(0)) >= min_points)).alias("is_core"))


def linked_cells(core: DataFrame, pairs: DataFrame, dims: int, eps: float, deepest: int = 40) -> DataFrame:
    """Pairs of core cells that hold two core points within ``eps``.

    Instead of comparing all points of two cells, both are halved again and again: a pair of boxes that is
    surely within ``eps`` links the cells, a pair surely beyond is dropped, the rest is halved further.
    Boxes are distinct per level, so a crowded box counts once.
    """
    side = eps / math.sqrt(dims)
    open_pairs = pairs.filter("cell < other").join(core.select("cell").distinct(), "cell", "left_semi").join(
        core.select(F.col("cell").alias("other")).distinct(), "other", "left_semi")
    linked, level = None, 1
    where = [f"x{i}" for i in range(dims)]
    while True:
        size = side / 2 ** level
        box = [F.floor(F.col(f"x{i}") / size).alias(f"c{i}") for i in range(dims)]
        boxes = core.select("cell", *box, *where).groupBy("cell", *[f"c{i}" for i in range(dims)]).agg(
            *[F.min(x).alias(f"lo_{x}") for x in where], *[F.max(x).alias(f"hi_{x}") for x in where])
        both = open_pairs.join(boxes, "cell").alias("a").join(
            boxes.withColumnRenamed("cell", "other").alias("b"), "other")
        nearest, farthest = [], []
        for x in where:
            gap = F.greatest(F.col(f"a.lo_{x}") - F.col(f"b.hi_{x}"), F.col(f"b.lo_{x}") - F.col(f"a.hi_{x}"), F.lit(0.0))
            reach = F.greatest(F.col(f"a.hi_{x}") - F.col(f"b.lo_{x}"), F.col(f"b.hi_{x}") - F.col(f"a.lo_{x}"))
            nearest.append(gap * gap)
            farthest.append(reach * reach)
        judged = both.select("cell", "other", (reduce(add, farthest) <= eps * eps).alias("near"),
                             (reduce(add, nearest) > eps * eps).alias("far"))
        verdict = cut_lineage(judged.groupBy("cell", "other").agg(F.bool_or("near").alias("near"), F.bool_and("far").alias("far")))
        sure = verdict.filter("near").select("cell", "other")
        linked = sure if linked is None else linked.unionByName(sure)
        open_pairs = verdict.filter("not near and not far").select("cell", "other")
        level += 2
        if open_pairs.isEmpty():
            return linked
        if level > deepest:
            # Points that no halving parts any more are compared themselves.
            spots = core.select("cell", *where).distinct()
            both = open_pairs.join(spots, "cell").alias("a").join(spots.withColumnRenamed("cell", "other").alias("b"), "other")
            return linked.unionByName(both.filter(squared_distance("a", "b", dims) <= eps * eps).select("cell", "other").distinct())


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest node of each connected component, by neighbour minima and label shortcuts.

    ``nodes``: node; ``edges``: a, b. The shortcut (label of my label) halves long chains every round.
    """
    both = cut_lineage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = cut_lineage(nodes.select("node", F.col("node").alias("label")))
    while True:
        offered = both.join(labels, both.a == labels.node).groupBy(F.col("b").alias("node")).agg(F.min("label").alias("offer"))
        better = labels.join(offered, "node", "left").select("node", F.least("label", "offer").alias("label"), F.col("label").alias("old"))
        root = better.select(F.col("node").alias("label"), F.col("label").alias("shortcut"))
        jumped = cut_lineage(better.join(root, "label").select("node", F.least("label", "shortcut").alias("label"), "old"))
        labels = jumped.select("node", "label")
        if jumped.filter("label <> old").isEmpty():
            return labels


def dbscan(df: DataFrame, id_col: str, columns: list[str], eps: float = 0.6, min_points: int = 10) -> DataFrame:
    """Cluster number per id; -1 is noise. Clusters are numbered by their smallest core id.

    A border point near several clusters joins the one with the smallest number.
    """
    dims = len(columns)
    placed = cut_lineage(points_in_cells(df, id_col, columns, eps))
    points = cut_lineage(core_points(placed, dims, eps, min_points))
    core = points.filter("is_core")
    cells = points.select("cell", *[f"c{i}" for i in range(dims)]).distinct()
    pairs = cut_lineage(adjacent_cells(cells, dims))
    nodes = core.select(F.col("cell").alias("node")).distinct()
    edges = linked_cells(core, pairs, dims, eps).select(F.col("cell").alias("a"), F.col("other").alias("b"))
    labels = components(nodes, edges).withColumnRenamed("node", "cell")
    first = core.groupBy("cell").agg(F.min("id").alias("first_id")).join(labels, "cell").groupBy("label").agg(
        F.min("first_id").alias("first_id"))
    named = numbered(first, [], [F.col("first_id")], F.floor(F.col("first_id") / 1_000_000), "rank").select(
        "label", (F.col("rank") - 1).cast("int").alias("cluster"))
    cell_cluster = labels.join(named, "label").select("cell", "cluster")
    # Border points: not core themselves, within eps of a core point of their own or an adjacent cell.
    lone = points.filter("not is_core")
    reach = pairs.unionByName(cells.select("cell", F.col("cell").alias("other"))).join(
        lone.select("cell").distinct(), "cell", "left_semi")
    helpers = core.join(cell_cluster, "cell").select(F.col("cell").alias("other"), "cluster", *[f"x{i}" for i in range(dims)]).join(reach, "other")
    border = (lone.alias("p").join(helpers.alias("q"), F.col("p.cell") == F.col("q.cell"))
              .filter(squared_distance("p", "q", dims) <= eps * eps)
              .groupBy(F.col("p.id").alias("id")).agg(F.min("q.cluster").alias("border")))
    return (points.join(cell_cluster, "cell", "left").join(border, "id", "left").select(
        F.col("id").alias(id_col), F.when(F.col("is_core"), F.col("cluster")).otherwise(F.coalesce("border", F.lit(-1))).alias("cluster"),
        "is_core"))


def cluster_name(cluster: Column) -> Column:
    return F.when(cluster == -1, "noise").otherwise(F.concat(F.lit("cluster_"), cluster.cast("string")))


def cluster_sizes(labelled: DataFrame) -> DataFrame:
    counts = labelled.groupBy("cluster").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    found = counts.agg(F.count_if(F.col("cluster") != -1)).scalar()
    return counts.select("cluster", cluster_name(F.col("cluster")).alias("name"), "n",
                         F.round(F.col("n") / total * 100, 2).alias("pct"), found.alias("n_clusters"))


def cluster_fraud_rates(labelled: DataFrame, flag_above: float = 0.5) -> DataFrame:
    table = labelled.groupBy("cluster").agg(
        F.count("label").alias("count"), F.sum(F.col("label").cast("long")).alias("fraud_count"), F.avg("label").alias("fraud_rate"))
    return table.select("*", cluster_name(F.col("cluster")).alias("cluster_name"),
                        (F.col("fraud_rate") > flag_above).alias("flagged")).orderBy(F.desc("fraud_rate"), "cluster")


def adjusted_rand_index(labelled: DataFrame, a: str, b: str) -> DataFrame:
    """From the contingency table; sums of n(n-1)/2 run in doubles so they cannot overflow."""
    pairs = lambda n: F.sum(F.col(n).cast("double") * (F.col(n) - 1) / 2)
    cells = labelled.groupBy(a, b).agg(F.count("*").alias("n"))
    both = cells.agg(pairs("n").alias("i"), F.sum("n").alias("n"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("n")).agg(pairs("n")).scalar()
    columns = cells.groupBy(b).agg(F.sum("n").alias("n")).agg(pairs("n")).scalar()
    table = both.select("i", (F.col("n").cast("double") * (F.col("n") - 1) / 2).alias("t"), rows.alias("r"), columns.alias("c"))
    expected, most = F.col("r") * F.col("c") / F.col("t"), (F.col("r") + F.col("c")) / 2
    return table.select(F.coalesce(F.try_divide(F.col("i") - expected, most - expected), F.lit(1.0)).alias("ari"))
