"""The 31 behaviour features per number, plus the main called country."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .prefix import previous_row

# Feature names in vector order, and the countries treated as high risk.
FEATURES = [
    "calls_per_hour_avg", "calls_per_hour_max", "peak_hour", "night_call_ratio", "burst_count_5min",
    "avg_time_between_calls_sec", "call_regularity_std", "weekend_ratio", "avg_duration_sec", "max_duration_sec",
    "min_duration_sec", "short_call_ratio", "duration_std", "unique_countries", "cross_border_ratio",
    "country_entropy", "high_risk_country_ratio", "voip_ratio", "unique_devices", "device_switch_count",
    "sms_to_call_ratio", "unique_callees", "reciprocity_ratio", "fan_out_ratio", "repeat_callee_ratio",
    "max_calls_to_single", "total_reports", "weighted_report_score", "report_density_per_day", "unique_reporters",
    "category_diversity",
]
HIGH_RISK_COUNTRIES = ["MM", "KH", "LA", "TH", "NG", "GH"]
HOME_COUNTRY = "TW"
ZERO_WITHOUT_REPORTS = FEATURES[-5:]


def busiest_window(calls: DataFrame, seconds: int = 300, slot_seconds: int = 3600) -> DataFrame:
    """Most calls of a number within any ``seconds``.

    Each number's calls are cut into time slots; calls near a slot's end also appear in the next slot as
    context, so slots are counted independently and a hot number spreads over its slots.
    """
    micros = F.unix_micros("ts")
    slot = F.floor(micros / (slot_seconds * 1_000_000))
    near_end = micros - slot * slot_seconds * 1_000_000 > (slot_seconds - seconds) * 1_000_000
    rows = calls.select("phone_number", micros.alias("us"), F.explode(F.when(
        near_end, F.array(F.struct(slot.alias("slot"), F.lit(True).alias("own")),
                          F.struct((slot + 1).alias("slot"), F.lit(False).alias("own")))).otherwise(
        F.array(F.struct(slot.alias("slot"), F.lit(True).alias("own"))))).alias("s")).select("phone_number", "us", "s.*")
    recent = (Window.partitionBy("phone_number", "slot").orderBy("us")
              .rangeBetween(-(seconds * 1_000_000 - 1), 0))
    counted = rows.select("phone_number", "own", F.count("*").over(recent).alias("n"))
    return counted.filter("own").groupBy("phone_number").agg(F.max("n").alias("burst_count_5min"))


def gap_measures(calls: DataFrame, slot: str = "hour") -> DataFrame:
    """Mean and spread of the time between calls, and device changes from one call to the next."""
    rows = calls.select("phone_number", "ts", "call_id", "device_fp")
    paired = previous_row(rows, ["phone_number"], ["ts", "call_id"], F.date_trunc(slot, "ts"), ["ts", "device_fp"], "prev")
    gap = (F.unix_micros("ts") - F.unix_micros("prev.ts")) / 1_000_000
    return paired.groupBy("phone_number").agg(
        F.coalesce(F.avg(gap), F.lit(0.0)).alias("avg_time_between_calls_sec"),
        F.coalesce(F.stddev_pop(gap), F.lit(0.0)).alias("call_regularity_std"),
        F.count_if(F.col("device_fp") != F.col("prev.device_fp")).alias("device_switch_count"))


def reciprocity(calls: DataFrame) -> DataFrame:
    """Share of a number's callees that also called it."""
    edges = calls.filter("callee_number <> ''").select("phone_number", "callee_number").distinct()
    back = edges.select(F.col("callee_number").alias("phone_number"), F.col("phone_number").alias("callee_number"))
    returned = edges.join(back, ["phone_number", "callee_number"], "left_semi").withColumn("returned", F.lit(1))
    return (edges.join(returned, ["phone_number", "callee_number"], "left").groupBy("phone_number")
            .agg(F.avg(F.coalesce("returned", F.lit(0))).alias("reciprocity_ratio")))


def vector_positions(table: DataFrame) -> DataFrame:
    """phone_number, position (from 1), name and value of every entry of the feature vector."""
    entries = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("name"), F.col(n).alias("value")) for i, n in enumerate(FEATURES, 1)])
    return table.select("phone_number", F.explode(entries).alias("e")).select("phone_number", "e.*")


def behavior_features(calls: DataFrame, reports: DataFrame) -> DataFrame:
    """One row per calling number. ``reports``: phone_number, ts, reporter, scam_category, weight."""
    calls = calls.select(
        "phone_number", "call_id", "ts", "is_voip", "device_fp", "callee_number", "sms_content_hash",
        F.coalesce("call_duration_sec", F.lit(0)).alias("d"),
        F.coalesce("callee_country", F.lit(HOME_COUNTRY)).alias("country"))
    hour, share = F.hour("ts"), lambda test: F.avg(test.cast("int"))
    base = calls.groupBy("phone_number").agg(
        F.count("*").alias("n"), F.avg("d").alias("avg_duration_sec"),
        F.max("d").alias("max_duration_sec"), F.min("d").alias("min_duration_sec"),
        F.stddev_pop("d").alias("duration_std"), share(F.col("d") < 10).alias("short_call_ratio"),
        share(F.col("is_voip")).alias("voip_ratio"), share(F.col("country") != HOME_COUNTRY).alias("cross_border_ratio"),
        share(F.col("country").isin(HIGH_RISK_COUNTRIES)).alias("high_risk_country_ratio"),
        share((hour >= 22) | (hour < 6)).alias("night_call_ratio"),
        share(F.weekday("ts") >= 5).alias("weekend_ratio"),
        share(F.coalesce(F.col("sms_content_hash"), F.lit("")) != "").alias("sms_to_call_ratio"))

    # Two-level counts: the first level is combined map-side, the second sees one row per distinct value.
    per_country = calls.groupBy("phone_number", "country").agg(
        F.count("*").alias("c"), F.min(F.struct("ts", "call_id")).alias("first"))
    p = F.col("c") / F.sum("c").over(Window.partitionBy("phone_number"))
    countries = per_country.select("*", p.alias("p")).groupBy("phone_number").agg(
        F.count("*").alias("unique_countries"), (-F.sum(F.col("p") * F.log2("p"))).alias("country_entropy"),
        F.min_by("country", F.struct((-F.col("c")).alias("c"), "first")).alias("primary_country"))
    per_callee = calls.filter("callee_number <> ''").groupBy("phone_number", "callee_number").agg(F.count("*").alias("c"))
    callees = per_callee.groupBy("phone_number").agg(
        F.count("*").alias("unique_callees"), F.max("c").alias("max_calls_to_single"),
        share(F.col("c") > 1).alias("repeat_callee_ratio"))
    devices = calls.filter("device_fp <> ''").groupBy("phone_number").agg(
        F.count_distinct("device_fp").alias("unique_devices"))
    per_hour = calls.groupBy("phone_number", F.date_trunc("hour", "ts").alias("h")).agg(F.count("*").alias("c"))
    hours = per_hour.groupBy("phone_number").agg(
        F.avg("c").alias("calls_per_hour_avg"), F.max("c").alias("calls_per_hour_max"))
    by_clock = per_hour.groupBy("phone_number", F.hour("h").alias("clock")).agg(F.sum("c").alias("c"))
    peak = by_clock.groupBy("phone_number").agg(
        F.min_by("clock", F.struct(-F.col("c"), F.col("clock"))).alias("peak_hour"))

    days = F.floor((F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))) / 86400)
    reported = reports.groupBy("phone_number").agg(
        F.count("*").alias("total_reports"), F.sum("weight").alias("weighted_report_score"),
        (F.count("*") / F.greatest(days, F.lit(1))).alias("report_density_per_day"))
    variety = reports.groupBy("phone_number").agg(
        F.count_distinct("reporter").alias("unique_reporters"),
        F.count_distinct("scam_category").alias("category_diversity"))

    parts = [base, countries, callees, devices, hours, peak, busiest_window(calls), gap_measures(calls),
             reciprocity(calls), reported, variety]
    joined = reduce(lambda a, b: a.join(b, "phone_number", "left"), parts)
    return joined.withColumn("fan_out_ratio", F.col("unique_callees") / F.col("n")).select(
        "phone_number", "primary_country",
        *[F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in FEATURES])
