"""Shapley values of boosted trees, exact and per row.

A tree without the features outside a set S follows both branches where it splits on them, weighted by how many training rows went each way. A leaf then
contributes its value times a product over the features of its path: 1 or 0 for those in S (does the row satisfy all their conditions),
the share of rows for the others. Shapley values of such a product follow from the coefficients of a polynomial in as many factors as the path has
features, so no subset is enumerated. All rows of a batch go through a leaf at once. The trees, whose size the
training settings bound, go to all tasks.
"""

from __future__ import annotations

from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch

#: A condition of a path: feature, bound, and whether values up to the bound go on.
Leaf = tuple[float, list[tuple[int, list[tuple[float, bool]], float]]]


def leaves_of(nodes: dict[int, dict], weight: float) -> list[Leaf]:
    """Value (times the tree's weight) of each leaf, and per feature of its path the conditions and the share of rows that went its way."""
    out: list[Leaf] = []

    def walk(i: int, path: dict[int, tuple[list, float]]) -> None:
        node = nodes[i]
        if node["left"] < 0:
            out.append((weight * node["value"], [(f, tests, share) for f, (tests, share) in path.items()]))
            return
        for child, low in ((node["left"], True), (node["right"], False)):
            tests, share = path.get(node["feature"], ([], 1.0))
            walk(child, path | {node["feature"]: ([*tests, (node["bound"], low)], share * nodes[child]["rows"] / node["rows"])})

    walk(0, {})
    return out


def trees_of(model: PipelineModel) -> list[Leaf]:
    """Leaves of all trees of the pipeline's last stage (boosted trees with splits on numbers), read from its saved form."""
    stage = model.stages[-1]
    spark = SparkSession.active()
    folder = scratch(spark, "trees")
    stage.write().save(folder)
    weights = list(stage.treeWeights)
    held = spark.read.parquet(f"{folder}/data").select("treeID", "nodeData.*").collect()  # as many as the settings allow
    trees: dict[int, dict[int, dict]] = {}
    for r in held:
        split = r["split"]
        leaf = r["leftChild"] < 0
        if not leaf and split["numCategories"] >= 0:
            raise ValueError("splits on categories are not supported")
        trees.setdefault(r["treeID"], {})[r["id"]] = {
            "value": r["prediction"], "rows": float(r["rawCount"]), "left": r["leftChild"], "right": r["rightChild"],
            "feature": -1 if leaf else split["featureIndex"], "bound": None if leaf else split["leftCategoriesOrThreshold"][0]}
    return [leaf for t, nodes in sorted(trees.items()) for leaf in leaves_of(nodes, weights[t])]


def shapley(leaves: list[Leaf], x: np.ndarray) -> tuple[float, np.ndarray]:
    """What the trees give without any feature, and the contribution of each feature (column) for each row of ``x``."""
    out, base = np.zeros(x.shape), 0.0
    for value, path in leaves:
        m = len(path)
        shares = [share for _, _, share in path]
        base += value * float(np.prod(shares))
        if not m:
            continue
        ones = []
        for f, tests, _ in path:
            fits = np.ones(len(x))
            for bound, low in tests:
                fits *= (x[:, f] <= bound) == low
            ones.append(fits)
        for j, (f, _, share) in enumerate(path):
            # Coefficients by the number of features in S, of the product over the other features.
            terms = [np.ones(len(x))]
            for k in range(m):
                if k != j:
                    more = [t * shares[k] for t in terms] + [0.0]
                    for i, t in enumerate(terms):
                        more[i + 1] = more[i + 1] + t * ones[k]
                    terms = more
            total = sum(factorial(i) * factorial(m - i - 1) / factorial(m) * t for i, t in enumerate(terms))
            out[:, f] += value * (ones[j] - share) * total
    return base, out


def contributions(model: PipelineModel, rows: DataFrame, features: list[str], id_col: str = "row_id") -> DataFrame:
    """id, base and one contribution per feature: they add up to the margin of the boosted trees. A null feature is a missing column's 0."""
    shipped = rows.sparkSession.sparkContext.broadcast(trees_of(model))
    own = rows.select(id_col, *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])

    def explain(batches):
        for pdf in batches:
            base, found = shapley(shipped.value, pdf[features].to_numpy(dtype=float))
            yield pd.DataFrame(found, columns=features).assign(**{id_col: pdf[id_col].to_numpy(), "base": base})[[id_col, "base", *features]]

    kind = dict(rows.dtypes)[id_col]
    return own.mapInPandas(explain, f"`{id_col}` {kind}, base double, " + ", ".join(f"`{f}` double" for f in features))


def importances(explained: DataFrame, features: list[str], n: int = 10) -> DataFrame:
    """The ``n`` features with the largest mean absolute contribution, ties by name."""
    means = explained.agg(*[F.avg(F.abs(F.col(f))).alias(f) for f in features])
    tall = means.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("importance")) for f in features])).alias("r")).select("r.*")
    return tall.orderBy(F.desc("importance"), "feature").limit(n)
