"""Training sets: positives, hard and ordinary negatives, label noise, shuffled features."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .prefix import hash_numbered
from .quantiles import exact_quantiles


def ranked(pool: DataFrame, id_col: str, seed: int) -> DataFrame:
    """``pool`` with the place of each row in seeded hash order, from 1."""
    return hash_numbered(pool, [], id_col, seed, "_rank")


def taken(placed: DataFrame, n: int) -> DataFrame:
    """``n`` rows of a ranked pool in its order; when the pool is smaller, it is gone through again from the start."""
    size = placed.count()
    if not size or n <= 0:
        return placed.limit(0).drop("_rank").withColumn("copy", F.lit(0))
    copies = F.floor((n - F.col("_rank")) / size)
    return placed.filter(F.col("_rank") <= n).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), copies.cast("int")))).drop("_rank")


def draw(pool: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """``n`` rows in seeded hash order; when the pool is smaller, it is gone through again from the start."""
    return taken(ranked(pool, id_col, seed), n)


def pools(features: DataFrame, known_good: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Numbers with two or more complaints, and in seeded hash order those with one and the known-good ones."""
    often = F.col("complaint_count_log") > math.log1p(1.5)
    once = features.filter(~often & (F.col("complaint_count_log") > 0))
    return features.filter(often), ranked(once, "caller_id", seed), ranked(known_good, "caller_id", seed)


def mixed(positive: DataFrame, once: DataFrame, good: DataFrame, negative_ratio: float, hard_ratio: float) -> DataFrame:
    """A training set of :func:`pools`."""
    negatives = int(positive.count() * negative_ratio)
    hard = round(negatives * min(max(hard_ratio, 0.0), 0.5))
    parts = [
        positive.withColumn("copy", F.lit(0)).withColumn("label", F.lit(1)).withColumn("origin", F.lit("positive")),
        taken(once, hard).withColumn("label", F.lit(0)).withColumn("origin", F.lit("hard")),
        taken(good, negatives - hard).withColumn("label", F.lit(0)).withColumn("origin", F.lit("soft")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.withColumn("row_id", F.concat_ws("#", "caller_id", "origin", "copy"))


def training_set(
    features: DataFrame, known_good: DataFrame, negative_ratio: float = 1.0, hard_ratio: float = 0.03, seed: int = 42
) -> DataFrame:
    """Numbers with two or more complaints against a mix of single-complaint and known-good numbers."""
    # Counting and drawing read the tables several times; write them once.
    return mixed(*pools(cut_lineage(features), cut_lineage(known_good), seed), negative_ratio, hard_ratio)


def label_quality_flags(rows: DataFrame, quality: str = "quality", share: float = 0.05) -> DataFrame:
    """Flag rows strictly below the interpolated ``share`` quantile of label quality."""
    cutoff = exact_quantiles(rows, {"q": F.col(quality)}, [share])["q"][0]
    return rows.withColumn("noisy", F.coalesce(F.col(quality) < cutoff, F.lit(False)))


def given_label_quality(scored: DataFrame) -> DataFrame:
    """Quality = probability that the model gives to the row's own label."""
    return scored.withColumn("quality", F.when(F.col("label") == 1, F.col("score")).otherwise(1 - F.col("score")))


def remove_noisy(rows: DataFrame, flagged: DataFrame, id_col: str) -> DataFrame:
    return rows.join(flagged.filter("noisy").select(id_col), id_col, "left_anti")


def flip_noisy(flagged: DataFrame) -> DataFrame:
    return flagged.withColumn("label", F.when(F.col("noisy"), 1 - F.col("label")).otherwise(F.col("label")))


def partnered(rows: DataFrame, id_col: str, columns: list[str], seed: int = 42) -> DataFrame:
    """Add ``_other``, the given columns of another row: two hash orders joined on their positions."""
    at = hash_numbered(rows, [], id_col, seed, "_at")
    other = hash_numbered(rows.select(id_col, *columns), [], id_col, seed + 1, "_at").select("_at", F.struct(*columns).alias("_other"))
    return at.join(other, "_at").drop("_at")


def shuffle_feature(rows: DataFrame, id_col: str, feature: str, seed: int = 42) -> DataFrame:
    """Permute one column over the rows."""
    return partnered(rows, id_col, [feature], seed).withColumn(feature, F.col("_other")[feature]).drop("_other")
