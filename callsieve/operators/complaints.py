"""Complaint cleaning, row flags and the 20 features per number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

# Feature names in vector order.
FEATURES = [
    "business_hour_ratio", "evening_ratio", "night_ratio", "school_hour_ratio", "weekend_ratio", "robocall_flag",
    "telemarketing_flag", "prerecorded_ratio", "abandoned_call_ratio", "live_voice_ratio", "indecency_flag",
    "cramming_flag", "issue_diversity", "complaint_count_log", "is_toll_free", "is_voip", "is_wireless",
    "unique_states_norm", "complaint_velocity", "multi_caller_flag",
]
OPTIONAL = ["call_type", "method", "advertiser", "state", "issue", "time_of_issue", "date_of_issue"]
FLAGS = [
    "is_business", "is_evening", "is_night", "is_school", "is_weekend", "has_hour", "has_weekday", "is_robocall",
    "is_telemarketing", "is_indecency", "is_cramming", "has_issue", "is_prerecorded", "is_abandoned", "is_live",
    "has_call_type", "is_voip", "is_wireless", "has_method", "has_advertiser", "advertiser_is_caller",
]


def clean(df: DataFrame, first: str = "2015-01-01", last: str = "2018-12-31") -> DataFrame:
    """Drop rows without a usable caller, type the date and time; absent columns become null."""
    for name in OPTIONAL:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    date = text.parse_date(F.col("date_of_issue"))
    return (
        df.filter(F.col("caller_id").isNotNull() & ~F.col("caller_id").isin(text.FAKE_NUMBERS))
        .withColumn("parsed_date", F.when(date.between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")), date))
        .withColumn("parsed_hour", text.parse_hour(F.col("time_of_issue")))
        .withColumn("day_of_week", F.weekday("parsed_date"))
        .withColumn("area_code", text.area_code(F.col("caller_id"))))


def row_flags(cleaned: DataFrame) -> DataFrame:
    hour, day, issue = F.col("parsed_hour"), F.col("day_of_week"), F.col("issue")
    kind, method, advertiser = F.col("call_type"), F.col("method"), F.col("advertiser")
    rules = {
        "is_business": (hour >= 9) & (hour < 17),
        "is_evening": (hour >= 18) & (hour < 22),
        "is_night": (hour >= 22) | (hour < 6),
        "is_school": (hour >= 8) & (hour < 15) & (day < 5),
        "is_weekend": day >= 5,
        "has_hour": hour.isNotNull(),
        "has_weekday": day.isNotNull(),
        "is_robocall": text.contains(issue, "robocall"),
        "is_telemarketing": text.contains(issue, "telemarketing"),
        "is_indecency": text.contains(issue, "indecency"),
        "is_cramming": text.contains(issue, "cramming|slamming"),
        "has_issue": issue.isNotNull(),
        "is_prerecorded": kind == "Prerecorded Voice",
        "is_abandoned": kind == "Abandoned Calls",
        "is_live": kind.isin("Live Voice", "Autodialed Live Voice Call"),
        "has_call_type": kind.isNotNull(),
        "is_voip": text.contains(method, "voip"),
        "is_wireless": text.contains(method, "wireless|cell phone"),
        "has_method": method.isNotNull(),
        "has_advertiser": advertiser.isNotNull(),
        "advertiser_is_caller": advertiser == F.col("caller_id"),
    }
    return cleaned.select("*", *[F.coalesce(rule, F.lit(False)).alias(n) for n, rule in rules.items()])


def ratio(part: str, whole: str, default: float) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(default))


def features(cleaned: DataFrame) -> DataFrame:
    """The 20 features per caller number.

    Rows are first summed per (number, issue, state). The two distinct counts then run over that much
    smaller table, not over the raw rows, and a hot number is combined before any shuffle.
    """
    first = row_flags(cleaned).groupBy("caller_id", "issue", "state").agg(
        F.count("*").alias("n"), F.min("parsed_date").alias("first_date"), F.max("parsed_date").alias("last_date"),
        *[F.count_if(f).alias(f) for f in FLAGS])
    sums = first.groupBy("caller_id").agg(
        F.sum("n").alias("n"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        F.count_distinct("issue").alias("issues"), F.count_distinct("state").alias("states"),
        *[F.sum(f).alias(f) for f in FLAGS])
    days = F.floor((F.unix_timestamp("last_date") - F.unix_timestamp("first_date")) / 86400)
    flag = lambda name: (F.col(name) > 0).cast("double")
    values = {
        "business_hour_ratio": ratio("is_business", "has_hour", 0.5),
        "evening_ratio": ratio("is_evening", "has_hour", 0.2),
        "night_ratio": ratio("is_night", "has_hour", 0.1),
        "school_hour_ratio": ratio("is_school", "has_hour", 0.3),
        "weekend_ratio": ratio("is_weekend", "has_weekday", 2 / 7),
        "robocall_flag": flag("is_robocall"),
        "telemarketing_flag": flag("is_telemarketing"),
        "prerecorded_ratio": ratio("is_prerecorded", "has_call_type", 0.0),
        "abandoned_call_ratio": ratio("is_abandoned", "has_call_type", 0.0),
        "live_voice_ratio": ratio("is_live", "has_call_type", 0.0),
        "indecency_flag": flag("is_indecency"),
        "cramming_flag": flag("is_cramming"),
        "issue_diversity": F.col("issues").cast("double"),
        "complaint_count_log": F.log1p("n"),
        "is_toll_free": text.is_toll_free(F.col("caller_id")).cast("double"),
        "is_voip": ratio("is_voip", "has_method", 0.0),
        "is_wireless": ratio("is_wireless", "has_method", 0.0),
        "unique_states_norm": F.least(F.col("states") / 50.0, F.lit(1.0)),
        "complaint_velocity": F.when(days > 0, F.col("n") / days).otherwise(F.col("n").cast("double")),
        "multi_caller_flag": ((F.col("has_advertiser") > 0)
                              & (F.col("advertiser_is_caller") < F.col("has_advertiser"))).cast("double"),
    }
    return sums.select("caller_id", *[values[n].alias(n) for n in FEATURES])


def diversity_counts(cleaned: DataFrame) -> DataFrame:
    """Complaints per number joined to its distinct issue and state counts."""
    total = cleaned.groupBy("caller_id").agg(F.count("*").alias("complaints"))
    issues = cleaned.groupBy("caller_id").agg(F.count_distinct("issue").alias("issues"))
    states = cleaned.groupBy("caller_id").agg(F.count_distinct("state").alias("states"))
    return (total.join(issues, "caller_id", "left").join(states, "caller_id", "left")
            .select("caller_id", "complaints", F.coalesce("issues", F.lit(0)).alias("issues"),
                    F.coalesce("states", F.lit(0)).alias("states")))


def to_calls(df: DataFrame) -> DataFrame:
    """Complaints as call records; the VoIP guess here differs from the feature's rule."""
    method = F.col("method") if "method" in df.columns else F.lit(None).cast("string")
    return df.filter(F.col("caller_id").isNotNull() & ~F.col("caller_id").isin(text.FAKE_NUMBERS)).select(
        F.format_string("fcc_%08d", "ticket_id").alias("call_id"), F.trim("caller_id").alias("phone_number"),
        F.lit("US").alias("caller_country"), F.lit("US").alias("callee_country"),
        text.contains(method, "robocall|prerecorded|auto-dialer").alias("is_voip"),
        F.lit(True).alias("reported_as_scam"))


def feature_vector(df: DataFrame, names: list[str]) -> Column:
    """Ordered array of the named features; absent or null features are 0."""
    return F.array(*[F.coalesce(F.col(n).cast("double"), F.lit(0.0)) if n in df.columns else F.lit(0.0) for n in names])


def vector_check(vector: Column, length: int) -> Column:
    size = F.size(vector)
    return F.when(size != length, F.concat(F.lit(f"Expected {length} features, got "), size.cast("string")))
