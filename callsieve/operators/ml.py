"""Training, scoring and model studies on Spark ML.

Feature tables have ``row_id``, ``label`` (0/1) and numeric feature columns. Models are Spark ML pipelines,
so fitting and scoring run on the executors; loops on the driver only go over models, folds or settings.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import dataset, evaluation, neighbors, sampling

Fit = Callable[[DataFrame, list[str]], PipelineModel]

#: Fits that run side by side, and the shares of the three-way split.
TOGETHER = 6
THREE_WAYS = [("train", 0.64), ("val", 0.16), ("test", 0.2)]


def side_by_side(spark, job: Callable, given: list) -> list:
    """``job`` of each of ``given``, in their order; the Spark jobs of several run at once."""
    with ThreadPool(max(1, min(TOGETHER, len(given)))) as pool:
        return pool.map(inheritable_thread_target(spark)(job), given, chunksize=1)


def assembled(features: list[str], scale: bool) -> list:
    stages = [VectorAssembler(inputCols=features, outputCol="raw_features" if scale else "features")]
    return stages + [StandardScaler(inputCol="raw_features", outputCol="features", withMean=True)] if scale else stages


def weighted(train: DataFrame, kind: str = "balanced") -> DataFrame:
    """Add ``weight``: balanced per class, or the negative/positive ratio on positives."""
    row = train.agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1")).first()
    n0, n1 = max(row["n0"], 1), max(row["n1"], 1)
    zero, one = ((n0 + n1) / (2 * n0), (n0 + n1) / (2 * n1)) if kind == "balanced" else (1.0, n0 / n1)
    return train.withColumn("weight", F.when(F.col("label") == 1, one).otherwise(zero))


def fit_lr(train: DataFrame, features: list[str], iterations: int = 100, reg: float = 0.01) -> PipelineModel:
    lr = LogisticRegression(labelCol="label", maxIter=iterations, regParam=reg)
    return Pipeline(stages=[*assembled(features, True), lr]).fit(train)


def fit_gbt(train: DataFrame, features: list[str], trees: int = 100, depth: int = 6, step: float = 0.1) -> PipelineModel:
    gbt = GBTClassifier(labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=step, seed=42)
    return Pipeline(stages=[*assembled(features, False), gbt]).fit(weighted(train, "ratio"))


def fit_rf(train: DataFrame, features: list[str], trees: int = 100, depth: int = 10) -> PipelineModel:
    rf = RandomForestClassifier(labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=42)
    return Pipeline(stages=[*assembled(features, False), rf]).fit(weighted(train))


def fourier_statement(train: DataFrame, features: list[str], gamma: float | None, size: int, seed: int = 42) -> str:
    """SQL for random Fourier features of the RBF kernel; standardising is folded into the weights."""
    stats = train.agg(*[f(c).alias(f"{c}__{i}") for c in features for i, f in enumerate((F.avg, F.stddev_pop))]).first()
    mean = np.array([stats[f"{c}__0"] or 0.0 for c in features])
    spread = np.array([stats[f"{c}__1"] or 1.0 for c in features])
    random = np.random.default_rng(seed)
    weights = random.normal(0.0, math.sqrt(2 * (gamma or 1.0 / len(features))), (size, len(features))) / spread
    shift = random.uniform(0.0, 2 * math.pi, size) - weights @ mean
    waves = []
    for i in range(size):
        inner = " + ".join(f"{w:.12e}D * `{c}`" for w, c in zip(weights[i], features))
        waves.append(f"{math.sqrt(2 / size):.12e}D * cos({shift[i]:.12e}D + {inner}) as rff_{i}")
    return f"select *, {', '.join(waves)} from __THIS__"


def svm_stages(statement: str, size: int, reg: float, iterations: int) -> list:
    return [SQLTransformer(statement=statement), *assembled([f"rff_{i}" for i in range(size)], False),
            LinearSVC(labelCol="label", weightCol="weight", regParam=reg, maxIter=iterations, predictionCol="side",
                      rawPredictionCol="margin"),
            LogisticRegression(featuresCol="margin", labelCol="label", maxIter=50)]


def fit_rbf_svm(train: DataFrame, features: list[str], gamma: float | None = None, size: int = 64, reg: float = 1e-3,
                iterations: int = 50) -> PipelineModel:
    """Approximate RBF SVM: random Fourier features, a linear SVM, and Platt scaling of its margin."""
    statement = fourier_statement(train, features, gamma, size)
    return Pipeline(stages=svm_stages(statement, size, reg, iterations)).fit(weighted(train))


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with ``score``, the probability of class 1."""
    scored = model.transform(rows if "weight" in rows.columns else rows.withColumn("weight", F.lit(1.0)))
    return scored.select(*rows.columns, vector_to_array("probability")[1].alias("score"))


def figures(scored: DataFrame, threshold: Column | float = 0.5) -> DataFrame:
    """One row: F1, precision, recall, accuracy at the threshold, and the two curve areas."""
    point = evaluation.metrics(scored, threshold).select("f1", "precision", "recall", "accuracy")
    return point.select("*", evaluation.roc_auc(scored).scalar().alias("roc_auc"),
                        evaluation.average_precision(scored).scalar().alias("auprc"))


def split(rows: DataFrame, shares: list[tuple[str, float]], seed: int = 42) -> dict[str, DataFrame]:
    """Stratified parts of a feature table, written once so that repeated fits do not rebuild it."""
    marked = cut_lineage(sampling.stratified_split(rows, "label", "row_id", shares, seed))
    return {name: marked.filter(F.col("split") == name).drop("split") for name, _ in shares}


def train_test(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    parts = split(rows, [("train", 0.8), ("test", 0.2)])
    return parts["train"], parts["test"]


def stacked(parts: list[DataFrame]) -> DataFrame:
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def compare_models(rows: DataFrame, features: list[str], fits: dict[str, Fit]) -> DataFrame:
    """Test figures of each model on the same split."""
    train, test = train_test(rows)
    return stacked([figures(cut_lineage(score(fit(train, features), test))).withColumn("model", F.lit(name))
                    .withColumn("position", F.lit(i)) for i, (name, fit) in enumerate(fits.items())])


def best_model(comparison: DataFrame) -> DataFrame:
    """Highest test F1; the first listed wins a tie."""
    return comparison.orderBy(F.desc("f1"), "position").limit(1)


def cross_validate(rows: DataFrame, features: list[str], fit: Fit, k: int = 5) -> DataFrame:
    """F1 per fold with the mean and twice the deviation over folds."""
    folded = cut_lineage(sampling.stratified_folds(rows, "label", "row_id", k))
    parts = []
    for i in range(k):
        model = fit(folded.filter(F.col("fold") != i).drop("fold"), features)
        held = score(model, folded.filter(F.col("fold") == i).drop("fold"))
        parts.append(evaluation.metrics(held).select(F.lit(i).alias("fold"), "f1"))
    table = cut_lineage(stacked(parts))
    facts = table.agg(F.avg("f1").alias("m"), (2 * F.stddev_pop("f1")).alias("s"))
    return table.select("*", facts.select("m").scalar().alias("f1_mean"), facts.select("s").scalar().alias("f1_two_sigma"))


def grid_search(rows: DataFrame, features: list[str], regs: list[float], gammas: list[float | None], k: int = 3,
                size: int = 32, iterations: int = 20) -> DataFrame:
    """Mean fold F1 of the RBF SVM for every setting; folds are the stratified ones."""
    spark = rows.sparkSession
    train = cut_lineage(weighted(sampling.stratified_folds(rows, "label", "row_id", k)))
    judge = MulticlassClassificationEvaluator(labelCol="label", metricName="fMeasureByLabel", metricLabel=1.0)

    def folds(gamma: float | None) -> list[float]:
        # The Fourier features of a width are the same for all folds and penalties: they are written once.
        *waves, svm, platt = svm_stages(fourier_statement(train, features, gamma, size), size, regs[0], iterations)
        table = cut_lineage(Pipeline(stages=waves).fit(train).transform(train).select("label", "weight", "fold", "features"))
        search = CrossValidator(estimator=Pipeline(stages=[svm, platt]), estimatorParamMaps=ParamGridBuilder().addGrid(svm.regParam, regs).build(),
                                evaluator=judge, numFolds=k, foldCol="fold", parallelism=len(regs))
        return search.fit(table).avgMetrics

    found = side_by_side(spark, folds, gammas)
    settings = [(float(g or 1.0 / len(features)), float(reg), float(m)) for g, means in zip(gammas, found) for reg, m in zip(regs, means)]
    best = max(m for _, _, m in settings)
    return spark.createDataFrame(settings, "gamma double, reg double, mean_f1 double").withColumn(
        "is_best", F.col("mean_f1") == best)


def importances(model: PipelineModel, features: list[str], spark, n: int = 10) -> DataFrame:
    pairs = [(f, float(v)) for f, v in zip(features, model.stages[-1].featureImportances.toArray())]
    return spark.createDataFrame(pairs, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(n)


def label_quality(rows: DataFrame, features: list[str], k: int = 5) -> DataFrame:
    """Out-of-fold probability that a model gives to each row's own label."""
    folded = cut_lineage(sampling.stratified_folds(rows, "label", "row_id", k))
    parts = []
    for i in range(k):
        model = fit_lr(folded.filter(F.col("fold") != i).drop("fold"), features)
        parts.append(score(model, folded.filter(F.col("fold") == i).drop("fold")))
    return cut_lineage(dataset.given_label_quality(stacked(parts)))


def oversampled(train: DataFrame, features: list[str]) -> DataFrame:
    """SMOTE on a feature table."""
    packed = train.select("row_id", F.array(*[F.col(f"`{f}`").cast("double") for f in features]).alias("vector"), "label")
    grown = neighbors.smote(packed, "row_id", "vector", "label")
    return cut_lineage(grown.select("row_id", "label", *[F.col("vector")[i].alias(f) for i, f in enumerate(features)]))


def refinement_report(rows: DataFrame, features: list[str], fit: Fit) -> DataFrame:
    """Test F1 of the plain model, with oversampling, and with noisy labels removed before oversampling."""
    train, test = train_test(rows)
    flagged = dataset.label_quality_flags(label_quality(train, features))
    cleaned = dataset.remove_noisy(train, flagged, "row_id")
    steps = {"baseline": train, "smote": oversampled(train, features), "refined": oversampled(cleaned, features)}

    def report(name: str) -> Row:
        data = steps[name]
        return evaluation.metrics(score(fit(data, features), test)).select(F.lit(name).alias("step"), "f1", F.lit(data.count()).alias("train_rows")).first()

    found = side_by_side(rows.sparkSession, report, list(steps))
    table = rows.sparkSession.createDataFrame(found, "step string, f1 double, train_rows long")
    return table.withColumn("lift", F.col("f1") - F.lit(found[0]["f1"]))


def tuned(parts: dict[str, DataFrame], features: list[str], fit: Fit) -> tuple[DataFrame, float]:
    """Scored test rows, and the threshold with the best F1 on validation, of a model fitted on train."""
    model = fit(parts["train"], features)
    return score(model, parts["test"]), evaluation.f1_threshold(score(model, parts["val"])).first()["threshold"]


def validated_figures(rows: DataFrame, features: list[str], fit: Fit) -> DataFrame:
    """Three-way split: fit on train, choose the F1 threshold on validation, report on test."""
    scored, threshold = tuned(split(rows, THREE_WAYS), features, fit)
    return figures(cut_lineage(scored), threshold).withColumn("threshold", F.lit(threshold))


def ablation(rows: DataFrame, features: list[str], feature: str, fit: Fit) -> DataFrame:
    """Figures without a feature, with it zeroed, and with it shuffled, against the full set."""
    rest = [f for f in features if f != feature]
    variants = {
        "baseline": (rows, features), "remove_feature": (rows, rest),
        "zero_feature": (rows.withColumn(feature, F.lit(0.0)), features),
        "shuffle_feature": (dataset.shuffle_feature(rows, "row_id", feature), features),
    }
    return stacked([validated_figures(data, used, fit).withColumn("scenario", F.lit(name)) for name, (data, used) in variants.items()])


def permutation_importance(rows: DataFrame, features: list[str], chosen: list[str], fit: Fit) -> DataFrame:
    """Change of test F1 when one feature is shuffled; negative means that the feature matters."""
    spark = rows.sparkSession
    # Split and permutation depend on the row ids alone, so that all features share them.
    parts = split(dataset.partnered(rows, "row_id", chosen), THREE_WAYS)

    def f1(feature: str | None) -> float | None:
        data = parts if feature is None else {k: v.withColumn(feature, F.col("_other")[feature]) for k, v in parts.items()}
        return evaluation.metrics(*tuned({k: v.drop("_other") for k, v in data.items()}, features, fit)).first()["f1"]

    base, *found = side_by_side(spark, f1, [None, *chosen])
    table = spark.createDataFrame(list(zip(chosen, found)), "feature string, f1 double")
    return table.select("feature", F.round(F.col("f1") - F.lit(base), 4).alias("delta_f1"))


def hard_negative_sweep(table: DataFrame, known_good: DataFrame, features: list[str], ratios: list[float], fit: Fit) -> DataFrame:
    """Figures at the tuned threshold for each share of hard negatives."""
    # All ratios draw from the same ranked pools.
    pools = [cut_lineage(pool) for pool in dataset.pools(table, known_good)]

    def at(ratio: float) -> DataFrame:
        rows = cut_lineage(dataset.mixed(*pools, 1.0, ratio))
        return cut_lineage(validated_figures(rows, features, fit).select(
            F.lit(ratio).alias("hard_negative_ratio"), F.lit(rows.count()).alias("n_samples"), "*"))

    return stacked(side_by_side(table.sparkSession, at, ratios))


def score_numbers(model: PipelineModel, numbers: DataFrame, threshold: float) -> DataFrame:
    """Probability and predicted label of every number."""
    return score(model, numbers).withColumn("predicted", evaluation.predicted(threshold))


def silhouette(rows: DataFrame, id_col: str, columns: list[str], cluster: str, sample: int = 5000, seed: int = 42) -> DataFrame:
    """Mean silhouette by plain distance of the clustered points, noise left out, over ``sample`` of them; null with fewer than two clusters.

    Every sampled point is measured against all others. The sample, whose size is the bound, goes to all tasks.
    """
    kept = rows.filter(F.col(cluster) != -1).select(F.col(id_col).alias("id"), F.col(cluster).alias("cluster"), F.array(*[F.col(c).cast("double") for c in columns]).alias("v"))
    taken = cut_lineage(sampling.sample_n(kept, "id", sample, seed).select("cluster", "v"))
    held = taken.toPandas()
    points = np.stack(held["v"].to_numpy()) if len(held) else np.zeros((0, len(columns)))
    names, member = np.unique(held["cluster"].to_numpy(), return_inverse=True)
    sizes = np.bincount(member, minlength=len(names))
    shipped = rows.sparkSession.sparkContext.broadcast((points, member))

    def widths(batches):
        points, member = shipped.value
        order = {name: i for i, name in enumerate(names)}
        for pdf in batches:
            out = []
            for own, v in zip(pdf["cluster"], pdf["v"]):
                sums = np.bincount(member, np.sqrt(((points - v) ** 2).sum(1)), minlength=len(sizes))
                i = order[own]
                other = np.delete(sums / sizes, i)
                a = sums[i] / max(sizes[i] - 1, 1)
                b = other.min() if len(other) else 0.0
                out.append(0.0 if sizes[i] == 1 or max(a, b) == 0 else (b - a) / max(a, b))
            yield pd.DataFrame({"s": out}, dtype=float)

    value = F.avg("s") if len(names) > 1 else F.lit(None).cast("double")
    return taken.repartition(F.xxhash64("v")).mapInPandas(widths, "s double").agg(
        F.count("*").alias("points"), F.lit(len(names)).cast("long").alias("clusters"), value.alias("silhouette"))


def embed_2d(rows: DataFrame, id_col: str, vector: str, label: str, sample: int | None = None, seed: int = 42) -> DataFrame:
    """First two principal components of the standardised vectors, with the label."""
    rows = rows if sample is None else sampling.sample_n(rows, id_col, sample, seed)
    packed = rows.select(id_col, label, array_to_vector(F.col(vector).cast("array<double>")).alias("raw"))
    stages = [StandardScaler(inputCol="raw", outputCol="scaled", withMean=True), PCA(k=2, inputCol="scaled", outputCol="pc")]
    placed = Pipeline(stages=stages).fit(packed).transform(packed).withColumn("pc", vector_to_array("pc"))
    return placed.select(id_col, label, F.col("pc")[0].alias("x"), F.col("pc")[1].alias("y"))
