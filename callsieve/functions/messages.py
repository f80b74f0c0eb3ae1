"""Call events as JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVENT_SCHEMA = (
    "event_id string, phone_number string, caller_country string, callee_country string, call_duration_sec int,"
    " is_voip boolean, timestamp double, device_fingerprint string, sms_content_hash string, produced_at double")


def to_message(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns))


def parse_message(value: Column) -> Column:
    return F.from_json(value, EVENT_SCHEMA)


def fingerprint(text: Column) -> Column:
    return F.substring(F.md5(text), 1, 12)


def batch_summary(events: DataFrame, listed: list[str], topic: str = "call_events") -> DataFrame:
    return events.agg(
        F.lit(topic).alias("topic"), F.count("*").alias("events_produced"),
        F.count_distinct("phone_number").alias("unique_phone_numbers"),
        F.round(F.avg(F.col("is_voip").cast("int")), 6).alias("voip_ratio"),
        F.round(F.avg(F.col("phone_number").isin(listed).cast("int")), 6).alias("listed_ratio"))
