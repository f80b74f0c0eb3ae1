"""Queries on the fraud tables: cleaning, scaling, encoding, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as ops
from ..operators import sampling
from ..sources import views
from .oracle_views import over
from .registry import query

TYPED = """
select Phone_Number, try_cast(Report_Count as double) as Report_Count, try_cast(Financial_Loss as double) as Financial_Loss,
  coalesce(Age_Group, 'UNKNOWN') as Age_Group, coalesce(Education, 'UNKNOWN') as Education,
  coalesce(Cluster_ID, 'C_UNKNOWN') as Cluster_ID, cast(try_cast(Label as double) as int) as Label
from fraud where try_cast(Label as double) in (0, 1)"""
CLEANED = """
select * replace (greatest(coalesce(Report_Count, (select median(Report_Count) from typed)), 0) as Report_Count,
  greatest(coalesce(Financial_Loss, (select median(Financial_Loss) from typed)), 0) as Financial_Loss)
from typed where Cluster_ID <> 'C_POISON_BOT'"""
ZED = """
select * from cleaned where abs((Report_Count - (select avg(Report_Count) from cleaned))
  / (select stddev_pop(Report_Count) from cleaned)) < 3"""
CLIPPED = """
select * replace (greatest(least(Financial_Loss, (select quantile_cont(Financial_Loss, 0.99) from zed)),
  (select quantile_cont(Financial_Loss, 0.01) from zed)) as Financial_Loss) from zed"""
DERIVED = """
select *, Report_Count * Financial_Loss as report_loss_interaction, ln(1 + greatest(Financial_Loss, 0)) as financial_loss_log,
  (Report_Count > (select quantile_cont(Report_Count, 0.9) from clipped))::int as high_frequency_flag from clipped"""
CHAIN = {"typed": TYPED, "cleaned": CLEANED, "zed": ZED, "clipped": CLIPPED, "derived": DERIVED}
AGES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "UNKNOWN"]
EDUCATION = ["E0", "E1", "E2", "E3"]


def hot(column: str, values: list[str]) -> str:
    return ", ".join(f"coalesce({column} = '{v}', false)::int as \"{column}_{v}\"" for v in values)


def scaled(name: str, source: str) -> str:
    return (f"round(({name} - (select median({name}) from {source})) / (select case when q3 = q1 then 1 else q3 - q1 end"
            f" from (select quantile_cont({name}, 0.25) as q1, quantile_cont({name}, 0.75) as q3 from {source})), 6) as {name}")


def fraud(spark, sf):
    return ops.clean_fraud(views.fraud(spark, sf))


@query("fraud_clean", over("fraud", "select * from cleaned", typed=TYPED, cleaned=CLEANED))
def fraud_clean(spark, sf):
    return fraud(spark, sf)


@query("zscore_filter", over("fraud", "select Phone_Number, Report_Count from zed", typed=TYPED, cleaned=CLEANED, zed=ZED))
def zscore_filter(spark, sf):
    return ops.zscore_filter(fraud(spark, sf), "Report_Count").select("Phone_Number", "Report_Count")


@query("clip_percentile", over("fraud", """
select Phone_Number, round(greatest(least(Financial_Loss, (select quantile_cont(Financial_Loss, 0.99) from cleaned)),
  (select quantile_cont(Financial_Loss, 0.01) from cleaned)), 4) as Financial_Loss from cleaned""",
                               typed=TYPED, cleaned=CLEANED))
def clip_percentile(spark, sf):
    return ops.clip_percentile(fraud(spark, sf), "Financial_Loss").select(
        "Phone_Number", F.round("Financial_Loss", 4).alias("Financial_Loss"))


@query("robust_scale", over("fraud", f"""
select Phone_Number, {scaled('Report_Count', 'cleaned')}, {scaled('Financial_Loss', 'cleaned')} from cleaned""",
                            typed=TYPED, cleaned=CLEANED))
def robust_scale(spark, sf):
    table = ops.robust_scale(fraud(spark, sf), ["Report_Count", "Financial_Loss"])
    return table.select("Phone_Number", F.round("Report_Count", 6).alias("Report_Count"),
                        F.round("Financial_Loss", 6).alias("Financial_Loss"))


@query("standard_scale", over("fraud", """
select Phone_Number, round((Report_Count - avg(Report_Count) over ()) / stddev_pop(Report_Count) over (), 6) as Report_Count,
  round((Financial_Loss - avg(Financial_Loss) over ()) / stddev_pop(Financial_Loss) over (), 6) as Financial_Loss
from cleaned""", typed=TYPED, cleaned=CLEANED))
def standard_scale(spark, sf):
    table = ops.standard_scale(fraud(spark, sf), ["Report_Count", "Financial_Loss"])
    return table.select("Phone_Number", F.round("Report_Count", 6).alias("Report_Count"),
                        F.round("Financial_Loss", 6).alias("Financial_Loss"))


@query("one_hot", over("fraud", f"""
select Phone_Number, {hot('Age_Group', AGES)}, {hot('Education', EDUCATION)} from cleaned""", typed=TYPED, cleaned=CLEANED))
def one_hot(spark, sf):
    return ops.one_hot(fraud(spark, sf).select("Phone_Number", "Age_Group", "Education"), ["Age_Group", "Education"])


@query("fraud_features", over("fraud", f"""
select Phone_Number, Label, high_frequency_flag, {', '.join(scaled(c, 'derived') for c in ops.SCALED)},
  {hot('Age_Group', AGES)}, {hot('Education', EDUCATION)} from derived""", **CHAIN))
def fraud_features(spark, sf):
    table = ops.prepare_fraud(views.fraud(spark, sf))
    return table.withColumns({c: F.round(c, 6) for c in ops.SCALED})


LEGACY = """
select * replace (try_cast(Report_Count as double) as Report_Count, try_cast(Transaction_Amount as double) as Transaction_Amount,
  try_cast(Is_Fraud as double) as Is_Fraud) from legacy_fraud
where not coalesce(contains(Tags, '機器人測試'), false) and try_cast(Report_Count as double) < 5000"""
LEGACY_Z = """
select * from typed where abs((Report_Count - (select avg(Report_Count) from typed))
  / (select stddev_pop(Report_Count) from typed)) < 3"""


@query("legacy_clean", over("legacy_fraud", f"""
select Incident_ID, Is_Fraud, {scaled('Report_Count', 'z')}, {scaled('Transaction_Amount', 'z')},
  {hot('Victim_Demographic', ['adult', 'senior', 'student'])},
  {hot('Tags', ['click', 'error', 'purchase', 'signup', 'view'])} from z""", typed=LEGACY, z=LEGACY_Z))
def legacy_clean(spark, sf):
    table = ops.prepare_legacy(views.legacy_fraud(spark, sf))
    return table.withColumns({c: F.round(c, 6) for c in ("Report_Count", "Transaction_Amount")})


@query("dropna_subset", over("fraud", """
select Phone_Number, round(try_cast(Financial_Loss as double), 2) as Financial_Loss, Age_Group from fraud
where Financial_Loss is not null and Age_Group is not null"""))
def dropna_subset(spark, sf):
    table = views.fraud(spark, sf).dropna(subset=["Financial_Loss", "Age_Group"]).select(
        "Phone_Number", "Financial_Loss", "Age_Group")
    return table.withColumn("Financial_Loss", F.round(F.col("Financial_Loss").try_cast("double"), 2))


HASH = "md5(cast(event_id as varchar) || '|42')"


@query("sample_n", f"select event_id, user_id from events order by {HASH}, event_id limit 500")
def sample_n(spark, sf):
    return sampling.sample_n(views.events(spark, sf).select("event_id", "user_id"), "event_id", 500, seed=42)


@query("head_n", "select event_id, user_id, event_type from events order by event_id limit 200")
def head_n(spark, sf):
    return sampling.head_n(views.events(spark, sf).select("event_id", "user_id", "event_type"), "event_id", 200)


@query("shuffle_rows", f"select event_id, row_number() over (order by {HASH}, event_id) as position from events")
def shuffle_rows(spark, sf):
    return sampling.shuffled(views.events(spark, sf).select("event_id"), "event_id", seed=42)
