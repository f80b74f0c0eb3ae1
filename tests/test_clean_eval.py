"""Cleaning, profiling, evaluation, drift and experiment boundaries."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from callsieve.functions import normal
from callsieve.operators import abtest, clean, dataset, drift, evaluation, profile, sampling


def column(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def test_zscore_filter_edges(spark):
    assert clean.zscore_filter(column(spark, [1, 100]), "x").count() == 2
    assert clean.zscore_filter(column(spark, [5, 5, 5, None]), "x").count() == 4
    kept = clean.zscore_filter(column(spark, [1, 2, 3, None] * 10 + [1000]), "x")
    assert kept.count() == 30 and kept.filter("x is null").isEmpty()


def test_robust_scale_of_a_constant_is_zero(spark):
    assert {r["x"] for r in clean.robust_scale(column(spark, [4, 4, 4]), ["x"]).collect()} == {0.0}


def test_clip_keeps_nulls(spark):
    got = clean.clip_percentile(column(spark, [0, None, 50, 100]), "x", 0.25, 0.75)
    assert sorted((r["x"] for r in got.collect()), key=str) == [25.0, 50.0, 75.0, None]


def test_schema_route(spark):
    make = lambda names: spark.createDataFrame([tuple("1" for _ in names)], ", ".join(f"`{n}` string" for n in names))
    assert clean.detect_schema(make(["Tags", "Is_Fraud"])) == "legacy"
    assert clean.detect_schema(make(["Label", "Report_Count"])) == "production"
    assert clean.detect_schema(make(["Caller ID Number"])) == "complaints"
    with pytest.raises(ValueError):
        clean.detect_schema(make(["other"]))


def test_fraud_clean_defaults_and_clamps(spark):
    rows = [("1", "bad", "-5", None, "E", None, "1"), ("2", "4", None, "A", None, "C_POISON_BOT", "0"),
            ("3", "8", "10", "A", "E", "C1", "2"), ("4", "6", "20", "A", "E", "C1", "0")]
    names = "Phone_Number, Report_Count, Financial_Loss, Age_Group, Education, Cluster_ID, Label".split(", ")
    got = {r["Phone_Number"]: r for r in clean.clean_fraud(spark.createDataFrame(rows, names)).collect()}
    assert set(got) == {"1", "4"}
    assert got["1"]["Report_Count"] == 5.0 and got["1"]["Financial_Loss"] == 0.0  # median of 4 and 6; clamped
    assert (got["1"]["Age_Group"], got["1"]["Cluster_ID"]) == ("UNKNOWN", "C_UNKNOWN")


def test_all_levels_are_kept(spark):
    df = spark.range(1200).select(F.col("id").cast("string").alias("c"))
    assert len(clean.levels(df, "c")) == 1200
    assert set(clean.one_hot(df.limit(2), ["c"]).columns) == {"c_0", "c_1"}


def test_guarded_outliers(spark):
    few = column(spark, [1, 1, 1, 100])
    assert profile.iqr_outliers(few, ["x"]).first()["outliers"] == 1
    assert profile.iqr_outliers(few, ["x"], guarded=True).first()["outliers"] == 0


def test_duplicates_and_missing(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None)], "i int, s string")
    assert tuple(profile.duplicates(df).first()) == (4, 2, 50.0)
    assert {r["column"]: (r["missing"], r["missing_pct"], r["pass"]) for r in profile.missing(df).collect()} == {
        "i": (0, 0.0, True), "s": (1, 25.0, False)}


def scored(spark, pairs):
    return spark.createDataFrame([(float(s), y) for s, y in pairs], "score double, label int")


def test_areas_under_the_curves(spark):
    pairs = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1), (0.4, 0), (1.0, 1)]
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluation.roc_auc(scored(spark, pairs)).first()[0] == pytest.approx(want)
    assert evaluation.average_precision(scored(spark, [(0.9, 1), (0.8, 0), (0.7, 1)])).first()[0] == pytest.approx(0.5 + 0.5 * 2 / 3)


def test_threshold_ties_and_fallbacks(spark):
    assert evaluation.f1_threshold(scored(spark, [(0.2, 1), (0.6, 1), (0.1, 0)])).first()["threshold"] == 0.2
    none = evaluation.recall_threshold(scored(spark, [(0.9, 0), (0.55, 1), (0.2, 0)]), 0.75).first()
    assert none["threshold"] == 0.5 and none["recall"] == 1.0  # figures at the score nearest to 0.5
    good = evaluation.recall_threshold(scored(spark, [(0.9, 1), (0.5, 1), (0.2, 0)]), 0.75).first()
    assert (good["threshold"], good["recall"]) == (0.5, 1.0)


def test_confusion_matrix_has_all_cells(spark):
    assert evaluation.confusion_matrix(scored(spark, [(0.9, 1)])).count() == 4


def test_psi_edges(spark):
    base = lambda rows: spark.createDataFrame([(float(s), b) for s, b in rows], "score double, base boolean")
    same = base([(s / 10, b) for s in range(10) for b in (True, False)])
    assert drift.psi_total(same, F.col("base")).first()["psi"] == pytest.approx(0)
    bins = {r["bin"]: r for r in drift.psi_bins(base([(1.0, True), (1.2, True), (0.3, False)]), F.col("base")).collect()}
    assert bins[9]["baseline_pct"] == 0.5  # 1.0 is in the last bin, 1.2 only in the total
    assert bins[3]["current_pct"] == 1.0 and bins[0]["current_pct"] == 1e-6


@pytest.mark.parametrize("psi, hit, fpr, level", [
    (0.163, -0.06, 0, "CRITICAL"), (0.163, 0, 0, "MODERATE"), (0.05, 0.021, 0, "MODERATE"), (0.05, 0, 0, "STABLE"),
    (0.25, 0, 0, "MODERATE"), (0, 0, 0.021, "CRITICAL"), (0.10, -0.02, 0.02, "STABLE")])
def test_drift_severity(spark, psi, hit, fpr, level):
    assert spark.range(1).select(drift.severity(F.lit(psi), F.lit(hit), F.lit(fpr))).first()[0] == level


def test_latency_percentiles(spark):
    row = drift.latency_percentiles(column(spark, range(1, 101), "ms"), "ms").first()
    assert tuple(row) == (100, 50.5, pytest.approx(95.05), pytest.approx(99.01))
    assert drift.latency_sla(column(spark, [50.0], "ms"), "ms").first()["ok"]


def test_normal_distribution(spark):
    for z in (-9.0, -2.5, -0.3, 0.0, 0.7, 1.96, 6.9, 7.5):
        got = spark.range(1).select(normal.cdf(F.lit(z))).first()[0]
        assert got == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)), rel=1e-9, abs=1e-15)


ARMS = "experiment string, arm string, n long, hit_rate double, false_positive_rate double"


def test_z_test_without_variance_is_null(spark):
    arms = spark.createDataFrame([("e", "control", 100, 0.0, 0.1), ("e", "treatment", 100, 0.0, 0.3)], ARMS)
    rows = {r["metric"]: r for r in abtest.z_tests(arms).collect()}
    assert rows["hit_rate"]["p_value"] is None and rows["hit_rate"]["recommendation"] is None
    assert rows["false_positive_rate"]["is_significant"]
    assert abtest.assessment(abtest.z_tests(arms)).first()["assessment"] == "HOLD"


def test_z_test_figures(spark):
    arms = spark.createDataFrame([("e", "control", 10_000, 0.672, 0.04), ("e", "treatment", 10_000, 0.698, 0.04)], ARMS)
    row = abtest.z_tests(arms).filter("metric = 'hit_rate'").first()
    assert row["p_value"] < 0.001 and row["cohen_d"] == pytest.approx(0.056, abs=1e-3)
    assert (row["recommendation"], row["effect"]) == ("HOLD", "negligible")


def test_sample_sizes(spark):
    plans = spark.createDataFrame([("a", 0.67, 2.0), ("b", 0.67, 0.0), ("c", 0.5, 60.0)], "experiment string, baseline double, lift_pp double")
    got = {r["experiment"]: r for r in abtest.sample_size(plans).collect()}
    assert got["a"]["total"] == 2 * got["a"]["n_per_arm"] and 8000 < got["a"]["n_per_arm"] < 9000
    assert got["b"]["n_per_arm"] > got["a"]["n_per_arm"]  # a zero lift is planned as one point
    assert got["c"]["n_per_arm"] == 100


def test_label_noise_cutoff_is_strict(spark):
    df = spark.createDataFrame([(i, 0.9 if i else 0.1) for i in range(20)], "id long, quality double")
    assert [r["id"] for r in dataset.label_quality_flags(df).filter("noisy").collect()] == [0]


def test_stratified_parts(spark):
    df = spark.range(100).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    parts = sampling.stratified_split(df, "label", "id", [("train", 0.8), ("test", 0.2)])
    got = {(r["label"], r["split"]): r["count"] for r in parts.groupBy("label", "split").count().collect()}
    assert got == {(0, "train"): 60, (0, "test"): 15, (1, "train"): 20, (1, "test"): 5}
    folds = sampling.stratified_folds(df, "label", "id", 5).groupBy("label", "fold").count().collect()
    assert {r["count"] for r in folds if r["label"] == 1} == {5}


def test_draw_goes_round_a_short_pool(spark):
    pool = spark.createDataFrame([(f"n{i}",) for i in range(3)], "caller_id string")
    got = dataset.draw(pool, "caller_id", 8, 42).groupBy("caller_id").count().collect()
    assert sorted(r["count"] for r in got) == [2, 3, 3]
    assert dataset.draw(pool, "caller_id", 0, 42).isEmpty()
