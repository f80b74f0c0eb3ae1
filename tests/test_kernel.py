"""The landmark kernel machine against an exact one, solved row by row."""

from __future__ import annotations

import numpy as np
import pytest

from callsieve.operators import kernel, ml

SCHEMA = "row_id string, label int, u double, v double"


def rings(n, seed):
    rng = np.random.default_rng(seed)
    label = np.arange(n) % 3 == 0
    radius, angle = np.where(label, 1.0, 2.2) + rng.normal(0, 0.25, n), rng.uniform(0, 2 * np.pi, n)
    return np.stack([5 * radius * np.cos(angle), radius * np.sin(angle)], 1), label.astype(int)


def frame(spark, x, label):
    return spark.createDataFrame([(f"r{i}", int(y), float(a), float(b)) for i, ((a, b), y) in enumerate(zip(x, label))], SCHEMA)


def exact_margins(x, label, asked, gamma, cost=1.0, bias=10.0, sweeps=400):
    """Dual coordinate ascent over all rows; the constant kernel part stands for the intercept."""
    y, n = 2.0 * label - 1, len(label)
    limit = cost * np.where(label == 1, n / (2 * label.sum()), n / (2 * (n - label.sum())))
    gram = kernel.kernel(x, x, gamma) + bias
    alpha, at = np.zeros(n), np.zeros(n)  # at: the margin without its sign
    for _ in range(sweeps):
        for i in range(n):
            new = min(max(alpha[i] + (1 - y[i] * at[i]) / gram[i, i], 0.0), limit[i])
            at += (new - alpha[i]) * y[i] * gram[i]
            alpha[i] = new
    return (kernel.kernel(asked, x, gamma) + bias) @ (alpha * y)


@pytest.fixture(scope="module")
def data():
    return rings(500, 1), rings(1000, 2)


def test_decisions_are_those_of_the_exact_machine(spark, data):
    (x, label), (asked, truth) = data
    mean, spread = x.mean(0), x.std(0)
    exact = exact_margins((x - mean) / spread, label, (asked - mean) / spread, 0.5) > 0
    model = kernel.fit_kernel_svm(frame(spark, x, label), ["u", "v"])
    out = {r["row_id"]: r for r in model.transform(frame(spark, asked, truth).repartition(5)).select("row_id", "side", "prediction").collect()}
    side = np.array([out[f"r{i}"]["side"] for i in range(len(asked))]) > 0
    assert (side == exact).mean() >= 0.99 and (side == truth).mean() > 0.97
    scored = ml.figures(ml.score(model, frame(spark, asked, truth))).first()
    plain = ml.figures(ml.score(ml.fit_lr(frame(spark, x, label), ["u", "v"]), frame(spark, asked, truth))).first()
    assert scored["roc_auc"] > 0.99 > 0.7 > plain["roc_auc"]


def test_map_keeps_inner_products_and_does_not_depend_on_partitions(spark, data):
    (x, label), _ = data
    x, label = x[:60], label[:60]
    df = frame(spark, np.concatenate([x, x]), np.concatenate([label, label]))  # copies are one landmark
    marks = kernel.fit_landmarks(df, ["u", "v"], 0.5, size=60)
    assert len(np.unique(marks.landmarks, axis=0)) == 60
    phi = np.array([r["features"].toArray() for r in marks.transform(df.limit(40)).collect()])
    z = (x[:40] - marks.mean) / marks.spread
    assert np.allclose(phi @ phi.T, kernel.kernel(z, z, 0.5), atol=1e-4)
    again = kernel.fit_landmarks(df.repartition(7), ["u", "v"], 0.5, size=60)
    assert np.allclose(again.landmarks, marks.landmarks)


def test_odd_rows(spark):
    rows = [("a", 0, None, 1.0), ("b", 1, 2.0, 1.0), ("c", 1, 2.0, 1.0), ("d", 0, 0.0, 1.0)]  # a missing value, copies, a constant column
    df = spark.createDataFrame(rows, SCHEMA)
    model = kernel.fit_kernel_svm(df, ["u", "v"], iterations=5)
    assert ml.score(model, df).count() == 4 and ml.score(model, df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        kernel.fit_landmarks(df.limit(0), ["u", "v"])


def test_grid_has_every_setting_and_prefers_curved_ones(spark, data):
    (x, label), _ = data
    got = kernel.grid_search(frame(spark, x, label), ["u", "v"], [0.01, 1.0], [None, 1e-6], k=2, size=40, iterations=30).collect()
    assert [(r["gamma"], r["cost"]) for r in got] == [(0.5, 0.01), (0.5, 1.0), (1e-6, 0.01), (1e-6, 1.0)]
    best = [r for r in got if r["is_best"]]
    assert best[0]["gamma"] == 0.5 and best[0]["mean_f1"] == max(r["mean_f1"] for r in got) > 0.95
