"""Score drift: PSI, snapshots, severity, latency limits."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .evaluation import metrics, ratio
from .quantiles import exact_quantiles

# Fixed values.
PSI_BINS, PSI_EPSILON = 10, 1e-6
PSI_STABLE, PSI_MODERATE = 0.10, 0.25
LATENCY_LIMIT_MS = 50.0


def score_bin(score: Column, bins: int = PSI_BINS) -> Column:
    """Bin by comparing with the edges i/bins; the last bin includes 1; out of range gives null."""
    steps = reduce(add, [(score >= i / bins).cast("int") for i in range(1, bins)])
    return F.when(score.between(0, 1), steps)


def share_or_epsilon(n: Column, total: Column) -> Column:
    share = F.coalesce(n / total, F.lit(0.0))
    return F.when(share == 0, PSI_EPSILON).otherwise(share)


def psi_bins(scored: DataFrame, is_baseline: Column, bins: int = PSI_BINS) -> DataFrame:
    """Per-bin shares of the two halves; scores out of range count in the total only."""
    flagged = scored.select(score_bin(F.col("score"), bins).alias("bin"), is_baseline.alias("base"))
    counted = flagged.groupBy("bin").agg(F.count_if("base").alias("b"), F.count_if(~F.col("base")).alias("c"))
    spine = scored.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    totals = counted.agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    filled = spine.join(counted, "bin", "left").select(
        "bin", share_or_epsilon(F.col("b"), totals.select("b").scalar()).alias("baseline_pct"),
        share_or_epsilon(F.col("c"), totals.select("c").scalar()).alias("current_pct"))
    e, a = F.col("baseline_pct"), F.col("current_pct")
    return filled.withColumn("bin_psi", (a - e) * F.ln(a / e))


def psi_total(scored: DataFrame, is_baseline: Column, simple_limit: float = 0.15) -> DataFrame:
    return psi_bins(scored, is_baseline).agg(F.sum("bin_psi").alias("psi")).withColumn(
        "drifted", F.col("psi") >= simple_limit)


def snapshots(scored: DataFrame, period: Column, threshold: float) -> DataFrame:
    """One performance snapshot per period: hit rate, false-positive rate, precision, F1, rows."""
    table = metrics(scored.withColumn("taken_at", period), threshold, ["taken_at"])
    p, r = F.col("precision"), F.col("hit_rate")
    return table.select(
        "taken_at", F.col("recall").alias("hit_rate"), "fpr", "precision",
        (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n_predictions")).withColumn("f1", ratio(2 * p * r, p + r))


def psi_by_period(scored: DataFrame, period: Column) -> DataFrame:
    """PSI of every period against the first one. Works on period x bin counts only."""
    counts = scored.groupBy(period.alias("taken_at"), score_bin(F.col("score")).alias("bin")).agg(F.count("*").alias("n"))
    totals = counts.groupBy("taken_at").agg(F.sum("n").alias("total"))
    spine = totals.select("taken_at", "total", F.explode(F.sequence(F.lit(0), F.lit(PSI_BINS - 1))).alias("bin"))
    shares = spine.join(counts, ["taken_at", "bin"], "left").select(
        "taken_at", "bin", share_or_epsilon(F.col("n"), F.col("total")).alias("share"))
    first = totals.agg(F.min("taken_at").alias("f")).scalar()
    base = shares.filter(F.col("taken_at") == first).select("bin", F.col("share").alias("base"))
    return (shares.join(base, "bin").groupBy("taken_at")
            .agg(F.sum((F.col("share") - F.col("base")) * F.ln(F.col("share") / F.col("base"))).alias("psi")))


def metric_deltas(snaps: DataFrame) -> DataFrame:
    """Snapshots with their change against the first one (one row per period, so one window suffices)."""
    first = snaps.agg(*[F.min_by(c, "taken_at").alias(c) for c in ("hit_rate", "fpr")])
    return snaps.select(
        "*", (F.col("hit_rate") - first.select("hit_rate").scalar()).alias("hit_rate_delta"),
        (F.col("fpr") - first.select("fpr").scalar()).alias("fpr_delta"))


def severity(psi: Column, hit_delta: Column, fpr_delta: Column) -> Column:
    return (F.when((psi > PSI_MODERATE) | (hit_delta < -0.05) | (fpr_delta > 0.02), "CRITICAL")
            .when((psi > PSI_STABLE) | (F.abs(hit_delta) > 0.02), "MODERATE").otherwise("STABLE"))


def drift_report(scored: DataFrame, period: Column, threshold: float) -> DataFrame:
    """Severity per period with the retrain and investigate flags."""
    table = metric_deltas(snapshots(scored, period, threshold)).join(psi_by_period(scored, period), "taken_at")
    level = severity(F.col("psi"), F.round("hit_rate_delta", 12), F.round("fpr_delta", 12))
    return table.select(
        "taken_at", "psi", "hit_rate_delta", "fpr_delta", level.alias("severity"),
        (level == "CRITICAL").alias("requires_retraining"), (level != "STABLE").alias("requires_investigation"))


def metric_trend(snaps: DataFrame, last: int = 5) -> DataFrame:
    return snaps.orderBy(F.desc("taken_at")).limit(last)


def retrain_trigger(report: DataFrame) -> DataFrame:
    """The first critical period; later ones do not trigger again."""
    first = Window.partitionBy("requires_retraining").orderBy("taken_at")
    return (report.filter("requires_retraining").withColumn("rn", F.row_number().over(first))
            .filter("rn = 1").select("taken_at", "psi", "hit_rate_delta", F.lit("CRITICAL_DRIFT").alias("reason")))


def latency_percentiles(df: DataFrame, column: str) -> DataFrame:
    p50, p95, p99 = exact_quantiles(df, {"ms": F.col(column)}, [0.5, 0.95, 0.99])["ms"]
    return df.agg(F.count(column).alias("events")).select(
        "events", F.lit(p50).cast("double").alias("p50"), F.lit(p95).cast("double").alias("p95"),
        F.lit(p99).cast("double").alias("p99"))


def latency_sla(df: DataFrame, column: str, limit_ms: float = LATENCY_LIMIT_MS) -> DataFrame:
    return latency_percentiles(df, column).select("p99", F.lit(limit_ms).alias("limit_ms"), (F.col("p99") <= limit_ms).alias("ok"))
