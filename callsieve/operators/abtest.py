"""A/B experiments: arm metrics, sample sizes, two-proportion tests, assessment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normal
from .evaluation import ratio


def arm_metrics(rows: DataFrame) -> DataFrame:
    """Per experiment and arm: size, hit rate, false-positive rate, reporter score, precision, F1."""
    table = rows.groupBy("experiment", "arm").agg(
        F.count("*").alias("n"), F.avg("hit").alias("hit_rate"), F.avg("false_alarm").alias("false_positive_rate"),
        F.avg("reporter_score").alias("reporter_score_avg"))
    p, r = F.col("precision"), F.col("hit_rate")
    return (table.withColumn("precision", ratio(r, r + F.col("false_positive_rate")))
            .withColumn("f1", ratio(2 * p * r, p + r)))


def sample_size(plans: DataFrame, alpha: float = 0.05, power: float = 0.80) -> DataFrame:
    """Rows needed per arm. ``plans``: experiment, baseline, lift_pp (percentage points)."""
    z_alpha, z_beta = normal.quantile(1 - alpha / 2), normal.quantile(power)
    mde = F.col("lift_pp") / 100
    effect = F.when(F.abs(mde) > 1e-6, F.abs(mde)).otherwise(0.01)
    inside = lambda p: F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    p1, p2 = F.col("p1"), F.col("p2")
    middle = inside((p1 + p2) / 2)
    null_var, alt_var = 2 * middle * (1 - middle), p1 * (1 - p1) + p2 * (1 - p2)
    need = F.ceil(F.try_divide(F.pow(z_alpha * F.sqrt(null_var) + z_beta * F.sqrt(alt_var), F.lit(2.0)),
                               F.pow(p2 - p1, F.lit(2.0))))
    guarded = (F.abs(F.col("effect")) < 1e-6) | (null_var <= 0) | (alt_var <= 0)
    per_arm = F.when(guarded, F.lit(5000)).otherwise(F.greatest(F.coalesce(need, F.lit(5000)), F.lit(100))).cast("long")
    return (plans.select("experiment", "baseline", "lift_pp", mde.alias("mde"), effect.alias("effect"))
            .withColumn("p1", inside(F.col("baseline"))).withColumn("p2", inside(F.col("baseline") + F.col("effect")))
            .select("experiment", "baseline", "lift_pp", "mde", per_arm.alias("n_per_arm"), (2 * per_arm).alias("total")))


def effect_label(d: Column) -> Column:
    size = F.abs(d)
    return (F.when(size < 0.2, "negligible").when(size < 0.5, "small").when(size < 0.8, "medium").otherwise("large"))


def z_tests(arms: DataFrame, alpha: float = 0.05, confidence: float = 0.95) -> DataFrame:
    """One row per experiment and metric; the figures are null when the pooled error is 0."""
    metrics = ("hit_rate", "false_positive_rate")
    tall = arms.select("experiment", "arm", "n", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("p")) for m in metrics])).alias("m")).select(
        "experiment", "arm", "n", "m.*")
    pair = tall.groupBy("experiment", "metric").agg(
        *[F.max(F.when(F.col("arm") == arm, F.col(c))).alias(f"{c}{i}")
          for i, arm in ((1, "control"), (2, "treatment")) for c in ("n", "p")])
    n1, n2, p1, p2 = (F.col(c) for c in ("n1", "n2", "p1", "p2"))
    lift = F.col("absolute_lift")
    z_alpha, z_crit = normal.quantile(1 - alpha / 2), normal.quantile((1 + confidence) / 2)
    pooled = (p1 * n1 + p2 * n2) / (n1 + n2)
    spread = F.sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2)
    middle = (p1 + p2) / 2
    table = (
        pair.withColumn("absolute_lift", p2 - p1)
        .withColumn("se", F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n2)))
        .withColumn("z", F.try_divide(lift, F.col("se")))
        .withColumn("p_value", 2 * (1 - normal.cdf(F.abs("z"))))
        .withColumn("ci_lower", lift - z_crit * spread).withColumn("ci_upper", lift + z_crit * spread)
        .withColumn("cohen_d", ratio(lift, F.sqrt((p1 * (1 - p1) + p2 * (1 - p2)) / 2)))
        .withColumn("relative_lift_pct", ratio(lift * 100, p1))
        .withColumn("power_se", F.sqrt(2 * middle * (1 - middle) / F.least(n1, n2)))
        .withColumn("power", F.coalesce(normal.cdf(F.try_divide(F.abs(lift), F.col("power_se")) - z_alpha), F.lit(0.0))))
    sure, real = F.col("p_value") < alpha, F.abs("cohen_d") >= 0.2
    advice = (F.when(sure & real & (lift > 0), "SHIP").when(sure & ~real, "HOLD")
              .when(~sure & (F.col("power") < 0.5), "EXTEND").when(~sure, "STOP").otherwise("REVIEW"))
    figures = {
        "absolute_lift": lift, "relative_lift_pct": F.col("relative_lift_pct"), "z": F.col("z"), "p_value": F.col("p_value"),
        "ci_lower": F.col("ci_lower"), "ci_upper": F.col("ci_upper"), "cohen_d": F.col("cohen_d"), "power": F.col("power"),
        "effect": effect_label(F.col("cohen_d")), "is_significant": sure, "is_practical": real, "recommendation": advice,
    }
    known = F.col("se") != 0
    return table.select("experiment", "metric", p1.alias("control_value"), p2.alias("treatment_value"),
                        *[F.when(known, value).alias(name) for name, value in figures.items()])


def assessment(tests: DataFrame) -> DataFrame:
    """Net verdict per experiment from its two tests."""
    up = F.coalesce(F.col("is_significant") & (F.col("absolute_lift") > 0), F.lit(False))
    flags = tests.groupBy("experiment").agg(
        F.bool_or((F.col("metric") == "hit_rate") & up).alias("hit_up"),
        F.bool_or((F.col("metric") == "false_positive_rate") & up).alias("fpr_up"))
    return flags.select("*", F.when(F.col("hit_up") & F.col("fpr_up"), "CHECK_TRADEOFF")
                        .when(F.col("hit_up"), "SHIP").otherwise("HOLD").alias("assessment"))


def compare(tests: DataFrame, first: str, second: str) -> DataFrame:
    """Two experiments side by side per metric, with the second's extra lift."""
    side = lambda name, i: tests.filter(F.col("experiment") == name).select(
        "metric", *[F.col(c).alias(f"{c}_{i}") for c in ("absolute_lift", "p_value", "cohen_d")])
    return side(first, "a").join(side(second, "b"), "metric").withColumn(
        "incremental_lift", F.col("absolute_lift_b") - F.col("absolute_lift_a"))
