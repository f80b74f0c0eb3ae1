"""Clusters and neighbours against brute force on small fixtures."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from callsieve.operators import cluster, neighbors


def brute_dbscan(points, eps, least):
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    near = d <= eps
    core = near.sum(1) >= least
    labels, number = np.full(len(points), -1), 0
    for i in range(len(points)):
        if not core[i] or labels[i] >= 0:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if labels[j] < 0 and core[j]:
                labels[j] = number
                todo += list(np.flatnonzero(near[j]))
        number += 1
    for i in np.flatnonzero(~core):
        owners = labels[np.flatnonzero(near[i] & core)]
        if len(owners):
            labels[i] = owners.min()
    return labels, core


@pytest.mark.parametrize("dims", [1, 2, 4])
def test_dbscan_equals_brute_force(spark, dims):
    random = np.random.default_rng(dims)
    chain = np.linspace(0, 6, 60)[:, None] * np.ones(dims) / np.sqrt(dims)  # one long cluster
    crowd = np.concatenate([np.zeros((80, dims)) + 9, 9 + random.normal(0, 0.1, (40, dims))])  # a third of all points in one spot
    points = np.concatenate([chain, crowd, random.uniform(-3, 12, (120, dims)), 9.55 + random.normal(0, 0.05, (25, dims))])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id long, " + ", ".join(f"v{i} double" for i in range(dims)))
    got = {r["id"]: (r["cluster"], r["is_core"]) for r in cluster.dbscan(df, "id", [f"v{i}" for i in range(dims)], 0.45, 5).collect()}
    labels, core = brute_dbscan(points, 0.45, 5)
    assert [got[i][1] for i in range(len(points))] == list(core)
    assert [got[i][0] for i in range(len(points))] == list(labels)


def test_adjacent_cells_in_many_dimensions(spark):
    random = np.random.default_rng(9)
    dims = 9
    boxes = np.unique(np.concatenate([random.integers(-3, 60, (150, dims)) * (np.arange(dims) < 3), random.integers(0, 4, (100, dims))]), axis=0)
    names = [",".join(map(str, b)) for b in boxes]
    df = spark.createDataFrame([(n, *map(int, b)) for n, b in zip(names, boxes)], "cell string, " + ", ".join(f"c{i} long" for i in range(dims)))
    gap = (np.maximum(np.abs(boxes[:, None] - boxes[None]) - 1, 0) ** 2).sum(-1) <= dims
    want = {(names[i], names[j]) for i, j in zip(*np.nonzero(gap)) if i != j}
    for leaf_cells in (10, 1000):
        got = [(r["cell"], r["other"]) for r in cluster.adjacent_cells(df, dims, leaf_cells).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_dbscan_of_the_prepared_matrix(spark, monkeypatch):
    from callsieve.plans import clusters

    rows = clusters.matrix(spark, "/root/testdata/sf0.01").limit(2000).cache()
    monkeypatch.setattr(cluster, "LEAF_CELLS", 100)
    held = sorted(rows.collect(), key=lambda r: r["id"])
    labels, core = brute_dbscan(np.array([[r[x] for x in clusters.X] for r in held]), 0.6, 10)
    got = {r["id"]: (r["cluster"], r["is_core"]) for r in cluster.dbscan(rows, "id", clusters.X, 0.6, 10).collect()}
    assert [got[r["id"]] for r in held] == list(zip(labels, core))
    assert len(set(labels)) > 2


def test_components_of_a_long_chain(spark):
    nodes = spark.range(70).select(F.col("id").alias("node"))
    edges = spark.range(69).filter("id <> 40").select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r["node"]: r["label"] for r in cluster.components(nodes, edges).collect()}
    assert set(got.values()) == {0, 41} and got[40] == 0 and got[69] == 41


def test_rand_index(spark):
    df = spark.createDataFrame([(i % 3, (i + 1) % 3, i % 2) for i in range(30)], "a int, b int, c int")
    assert cluster.adjusted_rand_index(df, "a", "b").first()["ari"] == pytest.approx(1.0)
    assert cluster.adjusted_rand_index(df, "a", "c").first()["ari"] < 0.1


@pytest.mark.parametrize("block", [7, 1000])
def test_nearest_neighbours_equal_brute_force(spark, block):
    random = np.random.default_rng(5)
    points = np.concatenate([random.normal(0, 1, (60, 6)), random.normal(8, 0.3, (60, 6)), random.uniform(-20, 20, (30, 6)), np.ones((70, 6))])  # a third are copies
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, v array<double>")
    got = {}
    for r in neighbors.nearest(df, "id", "v", k=4, pivots=9, block_rows=block).collect():
        got.setdefault(r["id"], {})[r["rank"]] = r["distance"]
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for i in range(len(points)):
        assert [got[i][r] for r in range(1, 5)] == pytest.approx(sorted(d[i])[:4], abs=1e-6)


def test_oversampling_balances_between_neighbours(spark):
    random = np.random.default_rng(2)
    rows = [(i, [float(x) for x in random.normal(0 if i < 12 else 5, 1, 3)], int(i < 12)) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int")
    got = neighbors.smote(df, "id", "v", "label", k=3, pivots=4)
    counts = {(r["label"], r["synthetic"]): r["count"] for r in got.groupBy("label", "synthetic").count().collect()}
    assert counts == {(0, False): 38, (1, False): 12, (1, True): 26}
    small = np.array([v for _, v, y in rows if y])
    d = np.sqrt(((small[:, None] - small[None]) ** 2).sum(-1))
    for r in got.filter("synthetic").collect():
        base = int(r["id"].split("#")[0])
        ends = small[np.argsort(d[base])[1:4]]
        on_line = [np.linalg.norm(r["v"] - small[base]) + np.linalg.norm(e - np.array(r["v"])) - np.linalg.norm(e - small[base]) for e in ends]
        assert min(on_line) < 1e-6
    again = neighbors.smote(df.repartition(3), "id", "v", "label", k=3, pivots=4)
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))


def test_a_worker_holds_a_bounded_number_of_distances():
    """Slices, groups of cells and the choice of the nearest against plain forms."""
    for rows, width in ((10_000, 4096), (16_000, 16_000), (3, 10 ** 9), (0, 5)):
        parts = neighbors.slices(rows, width)
        assert [i for p in parts for i in range(rows)[p]] == list(range(rows))
        assert all(len(range(rows)[p]) * width <= max(neighbors.HELD_DISTANCES, width) for p in parts)
    random = np.random.default_rng(5)
    centers, counts = random.normal(size=(300, 8)), random.integers(0, 40, 300).astype(float)
    groups = neighbors.cell_groups(centers, counts, 500)
    assert sorted(np.concatenate(groups)) == list(np.flatnonzero(counts))
    # Far fewer groups than cells: a point that matters to all cells is copied once for each group.
    assert all(len(g) == 1 or counts[g].sum() <= 500 for g in groups) and len(groups) < counts.sum() / 500 * 3
    d = random.integers(0, 6, (50, 30)).astype(float)
    d[0, 3:] = d[1] = np.inf
    for k in (1, 5, 40):
        row, column = neighbors.k_smallest(d, k)
        want = [(i, j) for i in range(50) for j in np.argsort(d[i], kind="stable")[:k] if np.isfinite(d[i, j])]
        assert list(zip(row, column)) == want
