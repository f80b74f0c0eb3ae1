"""Model studies: the settings of their queries, and shared work against the plain way."""

from __future__ import annotations

import random

import pytest

from callsieve.operators import dataset, kernel, ml
from callsieve.plans import QUERIES, models
from callsieve.operators.complaints import FEATURES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    made = [(f"r{i}", i % 2, rng.gauss(i % 2, 1.0), rng.gauss(0.0, 1.0)) for i in range(400)]
    return spark.createDataFrame(made, "row_id string, label int, strong double, noise double")


def test_studies_run_their_full_settings(spark, monkeypatch):
    seen = {}
    for name in ("grid_search", "permutation_importance", "hard_negative_sweep", "refinement_report"):
        def kept(*args, name=name, **named):
            seen[name] = (args, named)
            return spark.createDataFrame([(0.5,)], "x double")

        monkeypatch.setattr(kernel if name == "grid_search" else ml, name, kept)
        QUERIES[name](spark, SF)
    args, named = seen["grid_search"]
    assert args[2:] == ([0.1, 1.0, 10.0, 100.0], [None, 0.01, 0.1, 1.0]) and named == {"k": 5}
    assert seen["permutation_importance"][0][2] == FEATURES
    assert seen["hard_negative_sweep"][0][3] == [i / 100 for i in range(11)]
    given, names, fit = seen["refinement_report"][0]
    assert len(names) == 64 and set(names) <= set(given.columns) and fit is ml.fit_gbt


def test_shared_permutation_equals_one_by_one(rows):
    used = ["strong", "noise"]
    base = ml.validated_figures(rows, used, ml.fit_lr).first()["f1"]
    plain = {f: round(ml.validated_figures(dataset.shuffle_feature(rows, "row_id", f), used, ml.fit_lr).first()["f1"] - base, 4) for f in used}
    assert {r["feature"]: r["delta_f1"] for r in ml.permutation_importance(rows, used, used, ml.fit_lr).collect()} == pytest.approx(plain)
    assert plain["strong"] < -0.05


def test_grid_has_every_setting_and_one_best(rows):
    got = ml.grid_search(rows, ["strong", "noise"], [0.1, 0.01], [None, 0.1], k=2, size=8, iterations=5).collect()
    assert [(r["gamma"], r["reg"]) for r in got] == [(0.5, 0.1), (0.5, 0.01), (0.1, 0.1), (0.1, 0.01)]
    assert max(r["mean_f1"] for r in got) == next(r["mean_f1"] for r in got if r["is_best"]) > 0.5


def test_sweep_draws_what_single_sets_draw(spark):
    made = [(f"c{i}", 2.0 if i < 40 else 0.7, i % 7 / 7) for i in range(120)]
    table = spark.createDataFrame(made, "caller_id string, complaint_count_log double, other double")
    good = spark.createDataFrame([(f"g{i}", 0.0, i % 5 / 5) for i in range(60)], table.schema)
    got = ml.hard_negative_sweep(table, good, ["complaint_count_log", "other"], [0.0, 0.1], ml.fit_lr).collect()
    for r in got:
        one = dataset.training_set(table, good, hard_ratio=r["hard_negative_ratio"])
        plain = ml.validated_figures(one, ["complaint_count_log", "other"], ml.fit_lr).first()
        assert r["n_samples"] == one.count() and r["f1"] == pytest.approx(plain["f1"])
