"""Tree explanations against enumeration over all subsets of features."""

from __future__ import annotations

from itertools import combinations
from math import exp, factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from callsieve.operators import explain, ml

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    x[:, 3] = 1.0  # never split on
    label = ((x[:, 0] + x[:, 1] * x[:, 2] > 0) ^ (rng.random(300) < 0.1)).astype(int)
    rows = spark.createDataFrame([(f"r{i}", int(y), *map(float, v)) for i, (y, v) in enumerate(zip(label, x))], "row_id string, label int, a double, b double, c double, d double")
    return ml.fit_gbt(rows, NAMES, trees=4, depth=3), rows, x


def without(leaves, row, held):
    """Value of the trees with the features ``held`` only: both branches elsewhere, by their shares."""
    total = 0.0
    for value, path in leaves:
        for f, tests, share in path:
            value *= all((row[f] <= bound) == low for bound, low in tests) if f in held else share
        total += value
    return total


def test_values_equal_enumeration(spark, fitted):
    model, _, x = fitted
    leaves = explain.trees_of(model)
    base, found = explain.shapley(leaves, x[:20])
    assert base == pytest.approx(without(leaves, x[0], ()))
    for row, got in zip(x[:20], found):
        for j in range(4):
            rest = [k for k in range(4) if k != j]
            want = sum(factorial(n) * factorial(3 - n) / factorial(4) * (without(leaves, row, {*s, j}) - without(leaves, row, s))
                       for n in range(4) for s in combinations(rest, n))
            assert got[j] == pytest.approx(want, abs=1e-12)
    assert not found[:, 3].any()


def test_contributions_add_up_to_the_margin(fitted):
    model, rows, _ = fitted
    both = explain.contributions(model, rows, NAMES).join(ml.score(model, rows).select("row_id", "score"), "row_id")
    for r in both.collect():
        margin = r["base"] + sum(r[f] for f in NAMES)
        assert 1 / (1 + exp(-2 * margin)) == pytest.approx(r["score"], abs=1e-9)


def test_importances_rank_by_mean_size(fitted):
    model, rows, _ = fitted
    explained = explain.contributions(model, rows, NAMES)
    top = explain.importances(explained, NAMES, 2).collect()
    assert len(top) == 2 and top[0]["importance"] >= top[1]["importance"] > 0 and "d" not in {r["feature"] for r in top}
    assert explain.contributions(model, rows.limit(0), NAMES).count() == 0
    nulls = rows.limit(3).withColumn("b", F.lit(None).cast("double"))
    assert explain.contributions(model, nulls, NAMES).filter("b is null").count() == 0
