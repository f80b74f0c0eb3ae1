"""RBF kernel classifier on landmarks (Nystroem).

A bounded sample of distinct rows are the landmarks. With K their kernel matrix and k(x) the kernel between x and each of them, the
map k(x) K^(-1/2) has the kernel's inner products on the span of the landmarks, so that a linear machine on it is the kernel machine
restricted to that span; with all rows as landmarks it is the exact one. Only landmarks come to the driver: ``size`` rows, whatever the table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import sampling
from .ml import side_by_side, weighted

#: Eigenvalues of the landmarks' kernel below this share of the largest are noise.
SPECTRUM_FLOOR = 1e-10


def kernel(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    apart = (x ** 2).sum(1)[:, None] + (y ** 2).sum(1)[None, :] - 2 * x @ y.T
    return np.exp(-gamma * np.maximum(apart, 0.0))


@dataclass
class LandmarkMap:
    """Standardised landmarks and the matrix that turns kernel values into coordinates."""

    features: list[str]
    gamma: float
    mean: np.ndarray
    spread: np.ndarray
    landmarks: np.ndarray
    whitening: np.ndarray

    def transform(self, rows: DataFrame) -> DataFrame:
        """Rows with the vector ``features``; a row with a missing feature counts as at that feature's mean."""
        gamma, mean, spread, landmarks, whitening = self.gamma, self.mean, self.spread, self.landmarks, self.whitening

        @F.pandas_udf("array<double>")
        def mapped(given: pd.Series) -> pd.Series:
            if given.empty:
                return pd.Series([], dtype=object)
            x = (np.stack(given.to_numpy()).astype(float) - mean) / spread
            return pd.Series(list(kernel(np.nan_to_num(x), landmarks, gamma) @ whitening))

        return rows.withColumn("features", array_to_vector(mapped(F.array(*[F.col(f"`{c}`").cast("double") for c in self.features]))))


def fit_landmarks(train: DataFrame, features: list[str], gamma: float | None = None, size: int = 128, seed: int = 42) -> LandmarkMap:
    """Landmarks are ``size`` distinct rows in the order of their hashed ids; ``gamma`` is one over the number of features unless given."""
    gamma = gamma or 1.0 / len(features)
    values = [F.col(f"`{c}`").cast("double") for c in features]
    stats = train.agg(*[f(v).alias(f"{name}{i}") for i, v in enumerate(values) for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([stats[f"m{i}"] or 0.0 for i in range(len(features))])
    spread = np.array([stats[f"s{i}"] or 1.0 for i in range(len(features))])
    distinct = train.groupBy(F.array(*values).alias("v")).agg(F.min("row_id").alias("row_id"))
    held = sampling.sample_n(distinct, "row_id", size, seed).orderBy("row_id").collect()
    if not held:
        raise ValueError("no rows to take landmarks from")
    landmarks = np.nan_to_num((np.array([r["v"] for r in held], dtype=float) - mean) / spread)
    power, axes = np.linalg.eigh(kernel(landmarks, landmarks, gamma))
    kept = power > SPECTRUM_FLOOR * power.max()
    return LandmarkMap(features, gamma, mean, spread, landmarks, axes[:, kept] / np.sqrt(power[kept]))


@dataclass
class KernelMachine:
    """A landmark map and the linear machine behind it; ``transform`` adds margin and probability as a Spark model does."""

    landmarks: LandmarkMap
    linear: PipelineModel

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.linear.transform(self.landmarks.transform(rows))


def machine(reg: float, iterations: int) -> list:
    """Stages from the mapped vector to margin and probability."""
    return [LinearSVC(labelCol="label", weightCol="weight", regParam=reg, maxIter=iterations, standardization=False, predictionCol="side",
                      rawPredictionCol="margin"),
            LogisticRegression(featuresCol="margin", labelCol="label", maxIter=50)]


def fit_kernel_svm(train: DataFrame, features: list[str], gamma: float | None = None, cost: float = 1.0, size: int = 128,
                   iterations: int = 100) -> KernelMachine:
    """Soft-margin machine of the RBF kernel with balanced class weights, and Platt scaling of its margin.

    ``cost`` is the price of a unit of slack per row. The mapped rows are written once for all iterations.
    """
    landmarks = fit_landmarks(train, features, gamma, size)
    mapped = cut_lineage(landmarks.transform(weighted(train)).select("label", "weight", "features"))
    stages = machine(1.0 / (cost * max(mapped.count(), 1)), iterations)
    return KernelMachine(landmarks, Pipeline(stages=stages).fit(mapped))


def grid_search(rows: DataFrame, features: list[str], costs: list[float], gammas: list[float | None], k: int = 5, size: int = 128,
                iterations: int = 100) -> DataFrame:
    """Mean fold F1 of the kernel machine for every width and cost; folds are stratified.

    All folds and costs of a width share one map, written once. Landmarks are taken without labels from all rows.
    """
    train = cut_lineage(weighted(sampling.stratified_folds(rows, "label", "row_id", k)))
    per_fit = max(train.count() * (k - 1) / k, 1)
    judge = MulticlassClassificationEvaluator(labelCol="label", metricName="fMeasureByLabel", metricLabel=1.0)

    def folds(gamma: float | None) -> list[float]:
        table = cut_lineage(fit_landmarks(train, features, gamma, size).transform(train).select("label", "weight", "fold", "features"))
        svm, platt = machine(1.0, iterations)
        settings = ParamGridBuilder().addGrid(svm.regParam, [1.0 / (c * per_fit) for c in costs]).build()
        return CrossValidator(estimator=Pipeline(stages=[svm, platt]), estimatorParamMaps=settings, evaluator=judge, numFolds=k,
                              foldCol="fold", parallelism=len(costs)).fit(table).avgMetrics

    found = side_by_side(rows.sparkSession, folds, gammas)
    table = [(float(g or 1.0 / len(features)), float(c), float(m)) for g, means in zip(gammas, found) for c, m in zip(costs, means)]
    best = max(m for _, _, m in table)
    return rows.sparkSession.createDataFrame(table, "gamma double, cost double, mean_f1 double").withColumn("is_best", F.col("mean_f1") == best)
