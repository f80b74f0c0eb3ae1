"""Model training and study queries over the complaint training set."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dataset, explain, kernel, ml
from ..operators.complaints import FEATURES
from ..session import cut_lineage
from ..sources import views
from .complaints import features, good_features
from .evaluation import rounded
from .registry import query

FITS = {
    "logistic_regression": ml.fit_lr,
    "boosted_trees": ml.fit_gbt,
    "random_forest": ml.fit_rf,
    "rbf_svm": kernel.fit_kernel_svm,
}


def training(spark, sf):
    return cut_lineage(dataset.training_set(features(spark, sf), good_features(spark, sf)).select("row_id", "label", *FEATURES))


def one(name):
    def build(spark, sf):
        return rounded(ml.compare_models(training(spark, sf), FEATURES, {name: FITS[name]}).drop("position"))

    return build


for _key, _name in (("train_lr", "logistic_regression"), ("train_gbt", "boosted_trees"), ("train_rf", "random_forest"),
                    ("train_rbf_svm", "rbf_svm")):
    query(_key)(one(_name))


@query("model_comparison")
def model_comparison(spark, sf):
    return rounded(ml.compare_models(training(spark, sf), FEATURES, FITS).drop("position"))


@query("best_model")
def best_model(spark, sf):
    table = ml.compare_models(training(spark, sf), FEATURES, FITS)
    return rounded(ml.best_model(table).drop("position"))


@query("cv_f1")
def cv_f1(spark, sf):
    return rounded(ml.cross_validate(training(spark, sf), FEATURES, ml.fit_lr, k=5))


@query("grid_search")
def grid_search(spark, sf):
    return rounded(kernel.grid_search(training(spark, sf), FEATURES, [0.1, 1.0, 10.0, 100.0], [None, 0.01, 0.1, 1.0], k=5))


@query("feature_importance_top10")
def feature_importance_top10(spark, sf):
    model = FITS["random_forest"](training(spark, sf), FEATURES)
    return ml.importances(model, FEATURES, spark)


@query("boosted_importance_top10")
def boosted_importance_top10(spark, sf):
    """The features that move the boosted trees' margin most, by exact Shapley values over all training rows."""
    rows = training(spark, sf)
    explained = explain.contributions(FITS["boosted_trees"](rows, FEATURES), rows, FEATURES)
    return rounded(explain.importances(explained, FEATURES))


@query("score_numbers")
def score_numbers(spark, sf):
    model = ml.fit_lr(training(spark, sf), FEATURES)
    return rounded(ml.score_numbers(model, features(spark, sf), 0.5).select("caller_id", "score", "predicted"))


@query("label_quality")
def label_quality(spark, sf):
    flagged = dataset.label_quality_flags(ml.label_quality(training(spark, sf), FEATURES))
    return rounded(flagged.select("row_id", "label", "quality", "noisy"))


def fraud_rows(spark, sf):
    """Embeddings as a feature table with an unbalanced label."""
    names = [f"f{i}" for i in range(64)]
    rows = views.table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("row_id"), (F.col("label") < 3).cast("int").alias("label"),
        *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    return cut_lineage(rows), names


@query("refinement_report")
def refinement_report(spark, sf):
    rows, names = fraud_rows(spark, sf)
    return rounded(ml.refinement_report(rows, names, ml.fit_gbt))


@query("ablation")
def ablation(spark, sf):
    return rounded(ml.ablation(training(spark, sf), FEATURES, "complaint_count_log", kernel.fit_kernel_svm))


@query("permutation_importance")
def permutation_importance(spark, sf):
    return ml.permutation_importance(training(spark, sf), FEATURES, FEATURES, kernel.fit_kernel_svm)


@query("hard_negative_sweep")
def hard_negative_sweep(spark, sf):
    table, good = cut_lineage(features(spark, sf)), cut_lineage(good_features(spark, sf))
    return rounded(ml.hard_negative_sweep(table, good, FEATURES, [i / 100 for i in range(11)], kernel.fit_kernel_svm))
