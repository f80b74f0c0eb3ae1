"""Hot-key detection, salted two-stage aggregation and per-number risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import risk_tier

MEASURES = ["call_count", "scam_reports", "total_duration", "voip_count", "weighted_scam_score"]


def bucket_of(value: Column, buckets: int) -> Column:
    """md5 of the text as a number modulo ``buckets``, which must divide 256 so two hex digits suffice."""
    return F.conv(F.substring(F.md5(value), 31, 2), 16, 10).cast("int") % buckets


def key_frequency(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("cnt"))


def hot_keys(df: DataFrame, key: str, threshold: int = 1000) -> DataFrame:
    return key_frequency(df, key).filter(F.col("cnt") >= threshold)


def skew_ratio(df: DataFrame, key: str, alert_above: float = 5.0) -> DataFrame:
    per_key = key_frequency(df, key).agg(F.max("cnt").alias("max_cnt"), F.avg("cnt").alias("avg_cnt"))
    ratio = F.try_divide(F.col("max_cnt"), F.col("avg_cnt"))
    return per_key.select("max_cnt", "avg_cnt", ratio.alias("skew_ratio"), (ratio > alert_above).alias("skew_alert"))


def hot_rows(df: DataFrame, key: str, row_id: str, threshold: int = 1000, salts: int = 32) -> DataFrame:
    """Rows of hot keys. Both sides carry a salt, so a hot key's rows spread over ``salts`` tasks."""
    salted = df.withColumn("_salt", bucket_of(F.col(row_id).cast("string"), salts))
    hot = hot_keys(df, key, threshold).select(key, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    return salted.join(hot, [key, "_salt"], "left_semi").drop("_salt")


def sums() -> list[Column]:
    """The measures of a group of calls."""
    return [F.count("*").alias("call_count"), F.count_if("reported_as_scam").alias("scam_reports"),
            F.sum("call_duration_sec").alias("total_duration"), F.count_if("is_voip").alias("voip_count"),
            F.sum(F.when(F.col("reported_as_scam"), F.col("weight")).otherwise(0.0)).alias("weighted_scam_score")]


def number_sums(df: DataFrame) -> DataFrame:
    """Sums per number. They are combined before the shuffle, so a hot number sends one row per task and needs no salt."""
    return df.groupBy("phone_number").agg(*sums())


def salted_partial(df: DataFrame, threshold: int = 1000, salts: int = 32) -> DataFrame:
    """Partial sums per (number, salt); only hot numbers get a salt, the rest have null.

    Every row is first summed under its salt, which map-side combining shrinks before the shuffle. The
    hot test is then a window over at most ``salts`` rows per number, instead of a join back to the calls;
    its partitioning by number also serves the two aggregations that follow.
    """
    by_salt = df.groupBy("phone_number", bucket_of(F.col("call_id").cast("string"), salts).alias("salt")).agg(*sums())
    of_number = F.sum("call_count").over(Window.partitionBy("phone_number"))
    flagged = by_salt.withColumn("_total", of_number).withColumn("salt", F.when(F.col("_total") >= threshold, F.col("salt")))
    return flagged.groupBy("phone_number", "salt").agg(*[F.sum(m).alias(m) for m in MEASURES])


def merged(partials: DataFrame) -> DataFrame:
    """Salted partial sums as sums per number."""
    return partials.groupBy("phone_number").agg(*[F.sum(m).alias(m) for m in MEASURES])


def number_risk(merged: DataFrame) -> DataFrame:
    """Rates and risk tier from sums per number."""
    rate, voip = F.col("scam_reports") / F.col("call_count"), F.col("voip_count") / F.col("call_count")
    return merged.select(
        "phone_number", *MEASURES, rate.alias("scam_rate"),
        (F.col("total_duration") / F.col("call_count")).alias("avg_duration"), voip.alias("voip_ratio"),
        risk_tier(rate, F.round("weighted_scam_score", 9), voip).alias("risk_level"))


def salted_key(phone: Column, salt: Column) -> Column:
    return F.when(salt.isNull(), phone).otherwise(F.format_string("%s_%02d", phone, salt))


def strip_salt(key: Column) -> Column:
    return F.regexp_replace(key, "_[0-9]+$", "")


def partition_load(partials: DataFrame, partitions: int = 32) -> DataFrame:
    """Records that each partition gets when Spark deals the salted keys by hash."""
    dealt = partials.repartition(partitions, "phone_number", "salt")
    return dealt.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.sum("call_count").alias("records"))


def skew_report(df: DataFrame, threshold: int = 1000, salts: int = 32, partitions: int = 32) -> DataFrame:
    partials = salted_partial(df, threshold, salts)
    load = partition_load(partials, partitions).agg(
        F.count("*").alias("active_partitions"), F.avg("records").alias("avg_records"),
        F.max("records").alias("max_records"), F.min("records").alias("min_records"),
        F.try_divide(F.max("records"), F.avg("records")).alias("post_salt_skew_ratio"))
    before = partials.groupBy("phone_number").agg(
        F.sum("call_count").alias("n"), F.max("salt").isNotNull().alias("hot")).agg(
        F.struct(F.try_divide(F.max("n"), F.avg("n")).alias("r"), F.count_if("hot").alias("h")).alias("s")).scalar()
    return load.select("*", F.lit(partitions).cast("long").alias("total_partitions"),
                       before["r"].alias("pre_salt_skew_ratio"), before["h"].alias("hot_keys_salted"))


def etl_summary(df: DataFrame, threshold: int = 1000) -> DataFrame:
    per_key = number_risk(number_sums(df))
    level = F.col("risk_level")
    n = F.col("call_count")
    return per_key.agg(
        F.sum(n).alias("total_records"), F.count("*").alias("unique_numbers"),
        F.count_if(n >= threshold).alias("hot_keys"), F.try_divide(F.max(n), F.avg(n)).alias("pre_salt_skew_ratio"),
        *[F.count_if(level == name).alias(f"risk_{name.lower()}") for name in ("HIGH", "MEDIUM", "LOW", "SAFE")])
