"""Classifier evaluation from scored tables (score in [0, 1], label 0/1); rows without a score or label are left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .prefix import running

EPSILON = 1e-8


def score_band(score: Column, bands: int = 4096) -> Column:
    """Bands that grow with the score: ``bands`` of them for each halving of it, so scores crowded near 0 are parted, too."""
    halving = F.floor(F.log2(F.greatest(score, F.lit(1e-300))))
    return halving * bands + F.floor((score / F.pow(F.lit(2.0), halving) - 1) * bands)


def unscored(scored: DataFrame) -> DataFrame:
    """How many rows have no score, and how many no label."""
    return scored.agg(F.count_if(F.col("score").isNull() | F.isnan("score")).alias("without_score"), F.count_if(F.col("label").isNull()).alias("without_label"))


def cumulative_counts(scored: DataFrame) -> DataFrame:
    """True and false positives at every distinct score, from high to low.

    Rows are combined per distinct score first, and that table is written once, since the running sums and
    the totals read it several times. The running sums then go score band by score band.
    """
    scored = scored.filter(F.col("score").isNotNull() & ~F.isnan("score") & F.col("label").isNotNull())
    by_score = cut_lineage(scored.groupBy("score").agg(
        F.sum(F.col("label").cast("long")).alias("pos"), F.sum(1 - F.col("label").cast("long")).alias("neg")))
    totals = by_score.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    cumulative = running(by_score, [], [F.desc("score")], -score_band(F.col("score")),
                         sums={"tp": F.col("pos"), "fp": F.col("neg")})
    return cumulative.select("score", "pos", "neg", "tp", "fp", totals.select("p").scalar().alias("p"),
                             totals.select("n").scalar().alias("n"))


def ratio(part: Column | str, whole: Column | str) -> Column:
    """Division with 0 for an empty denominator."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def pr_points(scored: DataFrame) -> DataFrame:
    """Precision and recall at each threshold."""
    return cumulative_counts(scored).select(
        F.col("score").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        ratio("tp", "p").alias("recall"))


def pr_curve(scored: DataFrame) -> DataFrame:
    """The PR curve with its closing point (recall 0, precision 1), which has no threshold."""
    last = scored.sparkSession.range(1).selectExpr(
        "cast(null as double) as threshold", "1.0D as precision", "0.0D as recall")
    return pr_points(scored).unionByName(last)


def roc_curve(scored: DataFrame) -> DataFrame:
    first = scored.sparkSession.range(1).selectExpr("cast(null as double) as threshold", "0.0D as fpr", "0.0D as tpr")
    return cumulative_counts(scored).select(
        F.col("score").alias("threshold"), ratio("fp", "n").alias("fpr"), ratio("tp", "p").alias("tpr")).unionByName(first)


def roc_auc(scored: DataFrame) -> DataFrame:
    """Rank-sum AUC; ties count half. Each positive beats the negatives below it."""
    below = F.col("n") - F.col("fp")
    return cumulative_counts(scored).agg(
        F.try_divide(F.sum(F.col("pos") * (below + F.col("neg") / 2)), F.max("p") * F.max("n")).alias("roc_auc"))


def average_precision(scored: DataFrame) -> DataFrame:
    return cumulative_counts(scored).agg(
        F.sum(ratio("pos", "p") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("average_precision"))


def predicted(threshold: Column | float) -> Column:
    return (F.col("score") >= threshold).cast("int")


def confusion_matrix(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """All four cells, empty ones included."""
    cells = [(a, b) for a in (0, 1) for b in (0, 1)]
    row = scored.agg(*[F.count_if((F.col("label") == a) & (predicted(threshold) == b)).alias(f"c{a}{b}") for a, b in cells])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("predicted"), F.col(f"c{a}{b}").alias("n")) for a, b in cells
    ])).alias("r")).select("r.*")


def metrics(scored: DataFrame, threshold: Column | float = 0.5, by: list[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1, false-positive rate and the class-0 figures, per group."""
    hit, y = predicted(threshold), F.col("label")
    counts = scored.groupBy(*by).agg(
        F.count_if((y == 1) & (hit == 1)).alias("tp"), F.count_if((y == 0) & (hit == 1)).alias("fp"),
        F.count_if((y == 1) & (hit == 0)).alias("fn"), F.count_if((y == 0) & (hit == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by, "tp", "fp", "fn", "tn", ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(fp, fp + tn).alias("fpr"), ratio(tn, tn + fn).alias("precision_0"), ratio(tn, tn + fp).alias("recall_0"),
        ratio(2 * tn, 2 * tn + fn + fp).alias("f1_0"))


def f1_threshold(scored: DataFrame) -> DataFrame:
    """Threshold with the best F1, the lowest one on ties, 0.5 without scores."""
    p, r = F.col("precision"), F.col("recall")
    points = pr_points(scored).withColumn("f1", 2 * p * r / (p + r + EPSILON))
    best = points.agg(F.max_by(F.struct("threshold", "f1"), F.struct("f1", -F.col("threshold"))).alias("b"))
    return best.select(F.coalesce("b.threshold", F.lit(0.5)).alias("threshold"), F.col("b.f1").alias("f1"))


def recall_threshold(scored: DataFrame, min_precision: float = 0.75) -> DataFrame:
    """Threshold with the best recall among those precise enough, else 0.5 with the figures nearest to it."""
    point = F.struct("threshold", "recall", "precision")
    enough = F.col("precision") >= min_precision
    found = pr_points(scored).agg(
        F.max_by(F.when(enough, point), F.when(enough, F.struct("recall", -F.col("threshold")))).alias("good"),
        F.min_by(point, F.struct(F.abs(F.col("threshold") - 0.5), "threshold")).alias("near"))
    best = F.coalesce("good", "near")
    return found.select(
        F.when(F.col("good").isNotNull(), F.col("good.threshold")).otherwise(0.5).alias("threshold"),
        best["recall"].alias("recall"), best["precision"].alias("precision"))


def threshold_compare(scored: DataFrame) -> DataFrame:
    """Figures at 0.5 and at the F1-optimal threshold."""
    best = f1_threshold(scored).select("threshold").scalar()
    columns = ["name", "threshold", "recall", "precision", "f1", "fpr"]
    default = metrics(scored, 0.5).withColumn("name", F.lit("default")).withColumn("threshold", F.lit(0.5))
    tuned = metrics(scored.withColumn("best", best), F.col("best")).withColumn("name", F.lit("optimal")).withColumn("threshold", best)
    return default.select(columns).unionByName(tuned.select(columns))


def overfit_check(scored: DataFrame, split: str, threshold: float = 0.5, f1_gap: float = 0.10,
                  accuracy_gap: float = 0.05) -> DataFrame:
    """Train minus test figures with the two gap rules."""
    by_split = metrics(scored, threshold, [split])
    row = by_split.agg(*[
        F.max(F.when(F.col(split) == s, F.col(m))).alias(f"{s}_{m}") for s in ("train", "test") for m in ("f1", "accuracy")])
    gap = F.col("train_f1") - F.col("test_f1")
    spread = F.abs(F.col("train_accuracy") - F.col("test_accuracy"))
    status = (F.when((F.col("train_f1") < 0.5) & (F.col("test_f1") < 0.5), "underfit")
              .when(gap > f1_gap, "overfit").otherwise("normal"))
    return row.select("*", gap.alias("f1_gap"), spread.alias("accuracy_gap"), (gap > f1_gap).alias("is_overfitting"),
                      status.alias("status"), (spread > accuracy_gap).alias("accuracy_overfit"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight n / (classes * n_class) per class, and negatives per positive."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    facts = counts.agg(F.sum("n").alias("total"), F.count("*").alias("k"),
                       F.try_divide(F.sum(F.when(F.col(label) == 0, F.col("n"))),
                                    F.sum(F.when(F.col(label) == 1, F.col("n")))).alias("ratio"))
    return counts.select(label, "n", (facts.select("total").scalar() / (facts.select("k").scalar() * F.col("n"))).alias("balanced_weight"),
                         facts.select("ratio").scalar().alias("neg_per_pos"))
