"""Queries on call records: hot keys, salted aggregation, risk tiers, event summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import messages, scoring
from ..operators import skew
from ..sources import views
from .oracle_views import over
from .registry import query

FREQ = "select phone_number, count(*) as cnt from calls group by 1"
SALT = "cast(('0x' || substr(md5(cast(call_id as varchar)), 31, 2)) as int) % 32"
PARTIAL = f"""
select phone_number, salt, count(*) as call_count, count(*) filter (reported_as_scam) as scam_reports,
  cast(sum(call_duration_sec) as bigint) as total_duration, count(*) filter (is_voip) as voip_count,
  sum(case when reported_as_scam then weight else 0 end) as weighted_scam_score
from (select c.*, case when count(*) over (partition by phone_number) >= 1000 then {SALT} end as salt from calls c)
group by 1, 2"""
RISK = """
select *, scam_reports / call_count as scam_rate, total_duration / call_count as avg_duration,
  voip_count / call_count as voip_ratio,
  case when scam_reports / call_count >= 0.7 or (weighted_scam_score >= 50 and voip_count / call_count > 0.8) then 'HIGH'
       when scam_reports / call_count >= 0.3 or weighted_scam_score >= 20 then 'MEDIUM'
       when scam_reports / call_count >= 0.1 then 'LOW' else 'SAFE' end as risk_level
from (select phone_number, count(*) as call_count, count(*) filter (reported_as_scam) as scam_reports,
        cast(sum(call_duration_sec) as bigint) as total_duration, count(*) filter (is_voip) as voip_count,
        round(sum(case when reported_as_scam then weight else 0 end), 6) as weighted_scam_score from calls group by 1)"""


@query("key_frequency", over("calls", FREQ))
def key_frequency(spark, sf):
    return skew.key_frequency(views.calls(spark, sf), "phone_number")


@query("hot_keys", over("calls", FREQ + " having count(*) >= 1000"))
def hot_keys(spark, sf):
    return skew.hot_keys(views.calls(spark, sf), "phone_number")


@query("top_keys", over("calls", FREQ + " order by cnt desc, phone_number limit 100"))
def top_keys(spark, sf):
    return skew.key_frequency(views.calls(spark, sf), "phone_number").orderBy(F.desc("cnt"), "phone_number").limit(100)


@query("skew_ratio", over("calls", """
select max(cnt) as max_cnt, round(avg(cnt), 6) as avg_cnt, round(max(cnt) / avg(cnt), 6) as skew_ratio,
  max(cnt) / avg(cnt) > 5 as skew_alert from f""", f=FREQ))
def skew_ratio(spark, sf):
    return (skew.skew_ratio(views.calls(spark, sf), "phone_number")
            .withColumn("avg_cnt", F.round("avg_cnt", 6)).withColumn("skew_ratio", F.round("skew_ratio", 6)))


@query("hot_rows_semi", over("calls", f"""
select call_id, phone_number, call_duration_sec from calls
where phone_number in (select phone_number from ({FREQ}) where cnt >= 1000)"""))
def hot_rows_semi(spark, sf):
    calls = views.calls(spark, sf).select("call_id", "phone_number", "call_duration_sec")
    return skew.hot_rows(calls, "phone_number", "call_id")


@query("salted_partial", over("calls", f"""
select phone_number, salt, call_count, scam_reports, total_duration, voip_count,
  round(weighted_scam_score, 6) as weighted_scam_score from ({PARTIAL})"""))
def salted_partial(spark, sf):
    return skew.salted_partial(views.calls(spark, sf)).withColumn(
        "weighted_scam_score", F.round("weighted_scam_score", 6))


@query("number_risk", over("calls", f"""
select phone_number, call_count, scam_reports, total_duration, voip_count, weighted_scam_score,
  round(scam_rate, 6) as scam_rate, round(avg_duration, 6) as avg_duration, round(voip_ratio, 6) as voip_ratio,
  risk_level from ({RISK})"""))
def number_risk(spark, sf):
    risk = skew.number_risk(skew.number_sums(views.calls(spark, sf)))
    for name in ("weighted_scam_score", "scam_rate", "avg_duration", "voip_ratio"):
        risk = risk.withColumn(name, F.round(name, 6))
    return risk


@query("risk_distribution", over("calls", f"select risk_level, count(*) as numbers from ({RISK}) group by 1"))
def risk_distribution(spark, sf):
    risk = skew.number_risk(skew.number_sums(views.calls(spark, sf)))
    return risk.groupBy("risk_level").agg(F.count("*").alias("numbers"))


@query("etl_summary", over("calls", f"""
select cast(sum(call_count) as bigint) as total_records, count(*) as unique_numbers,
  count(*) filter (call_count >= 1000) as hot_keys, round(max(call_count) / avg(call_count), 6) as pre_salt_skew_ratio,
  count(*) filter (risk_level = 'HIGH') as risk_high, count(*) filter (risk_level = 'MEDIUM') as risk_medium,
  count(*) filter (risk_level = 'LOW') as risk_low, count(*) filter (risk_level = 'SAFE') as risk_safe from ({RISK})"""))
def etl_summary(spark, sf):
    return skew.etl_summary(views.calls(spark, sf)).withColumn(
        "pre_salt_skew_ratio", F.round("pre_salt_skew_ratio", 6))


@query("skew_report")
def skew_report(spark, sf):
    report = skew.skew_report(views.calls(spark, sf))
    for name in ("avg_records", "post_salt_skew_ratio", "pre_salt_skew_ratio"):
        report = report.withColumn(name, F.round(name, 6))
    return report


@query("skew_totals", over("calls", """
select (select count(*) from calls) as records, cast(32 as bigint) as total_partitions,
  (select round(max(cnt) / avg(cnt), 6) from f) as pre_salt_skew_ratio, (select count(*) from f where cnt >= 1000) as hot_keys_salted""", f=FREQ, p=PARTIAL))
def skew_totals(spark, sf):
    """What in the partition report does not depend on Spark's hash."""
    report = skew.skew_report(views.calls(spark, sf))
    return report.select(F.round(F.col("avg_records") * F.col("active_partitions")).cast("long").alias("records"), "total_partitions",
                         F.round("pre_salt_skew_ratio", 6).alias("pre_salt_skew_ratio"), "hot_keys_salted")


@query("salt_key_roundtrip", over("calls", f"""
select call_id, phone_number || '_' || lpad(cast({SALT} as varchar), 2, '0') as salted, phone_number as stripped
from calls"""))
def salt_key_roundtrip(spark, sf):
    salted = skew.salted_key(F.col("phone_number"), skew.bucket_of(F.col("call_id").cast("string"), 32))
    return views.calls(spark, sf).select("call_id", salted.alias("salted"), skew.strip_salt(salted).alias("stripped"))


@query("distinct_sets", over("calls", """
select 'country' as kind, caller_country as item from calls union select 'device', device_fp from calls
union select 'number', phone_number from calls"""))
def distinct_sets(spark, sf):
    calls = views.calls(spark, sf)
    return calls.select(F.explode(F.create_map(
        F.lit("country"), "caller_country", F.lit("device"), "device_fp", F.lit("number"), "phone_number"
    )).alias("kind", "item")).distinct()


@query("distinct_approx", over("calls", """
select caller_country, count(distinct phone_number) as numbers, true as within_bound from calls group by 1"""))
def distinct_approx(spark, sf):
    """The sketch's count is within three standard errors of the exact one, which two-level counting gives."""
    calls = views.calls(spark, sf).select("caller_country", "phone_number")
    sketched = calls.groupBy("caller_country").agg(F.approx_count_distinct("phone_number", 0.02).alias("about"))
    exact = calls.distinct().groupBy("caller_country").agg(F.count("phone_number").alias("numbers"))
    return exact.join(sketched, "caller_country").select(
        "caller_country", "numbers", (F.abs(F.col("about") - F.col("numbers")) <= F.greatest(0.06 * F.col("numbers"), F.lit(1))).alias("within_bound"))


@query("event_batch_summary", over("calls", """
select 'call_events' as topic, count(*) as events_produced, count(distinct phone_number) as unique_phone_numbers,
  round(avg(case when is_voip then 1 else 0 end), 6) as voip_ratio,
  round(avg(case when phone_number in ('center-0', 'center-1', 'center-2') then 1 else 0 end), 6) as listed_ratio
from calls"""))
def event_batch_summary(spark, sf):
    return messages.batch_summary(views.calls(spark, sf), ["center-0", "center-1", "center-2"])


@query("device_fingerprint", over("calls", """
select call_id, substr(md5(phone_number || '|' || device_fp), 1, 12) as fingerprint from calls"""))
def device_fingerprint(spark, sf):
    return views.calls(spark, sf).select(
        "call_id", messages.fingerprint(F.concat_ws("|", "phone_number", "device_fp")).alias("fingerprint"))


@query("event_to_json", over("calls", """
select call_id, '{"event_id":"' || cast(call_id as varchar) || '","phone_number":"' || phone_number
  || '","caller_country":"' || caller_country || '","call_duration_sec":' || cast(call_duration_sec as varchar)
  || ',"is_voip":' || case when is_voip then 'true' else 'false' end || '}' as message,
  phone_number as parsed_phone, cast(call_duration_sec as int) as parsed_duration from calls"""))
def event_to_json(spark, sf):
    calls = views.calls(spark, sf).select(
        "call_id", F.col("call_id").cast("string").alias("event_id"), "phone_number", "caller_country",
        F.col("call_duration_sec").cast("int").alias("call_duration_sec"), "is_voip")
    body = messages.to_message(["event_id", "phone_number", "caller_country", "call_duration_sec", "is_voip"])
    parsed = messages.parse_message(F.col("message"))
    return calls.select("call_id", body.alias("message")).select(
        "call_id", "message", parsed["phone_number"].alias("parsed_phone"),
        parsed["call_duration_sec"].alias("parsed_duration"))


HEURISTIC = """
select call_id, round(s, 6) as score,
  case when s >= 0.7 then 'HIGH' when s >= 0.4 then 'MEDIUM' when s >= 0.15 then 'LOW' else 'SAFE' end as risk_level
from (select call_id, least(1.0, (case when is_voip then 0.35 else 0 end)::double
        + case when r > 0 then least(0.4, 0.1 * ln(1 + r)) else 0 end
        + (case when call_duration_sec < 5 then 0.10 when call_duration_sec > 30 and call_duration_sec < 180 then 0.05
             else 0 end)::double
        + (case when caller_country in ('TW', 'HK', 'SG', 'JP') then 0 else 0.15 end)::double) as s
      from (select *, call_id % 7 as r from calls))"""


@query("heuristic_score", over("calls", HEURISTIC))
def heuristic_score(spark, sf):
    score = scoring.heuristic_score(F.col("is_voip"), F.col("call_id") % 7, F.col("call_duration_sec"),
                                    F.col("caller_country"))
    return views.calls(spark, sf).select(
        "call_id", F.round(score, 6).alias("score"), scoring.probability_tier(score).alias("risk_level"))


@query("tumbling_hour", over("calls", """
select phone_number, date_trunc('hour', ts) as hour_start, count(*) as calls from calls group by 1, 2"""))
def tumbling_hour(spark, sf):
    return (views.calls(spark, sf).groupBy("phone_number", F.window("ts", "1 hour").alias("w"))
            .agg(F.count("*").alias("calls")).select("phone_number", F.col("w.start").alias("hour_start"), "calls"))


@query("sliding_5min", over("calls", """
select phone_number, time_bucket(interval 1 minute, ts) - to_minutes(m) as window_start, count(*) as calls
from calls, (select unnest([0, 1, 2, 3, 4]) as m) group by 1, 2"""))
def sliding_5min(spark, sf):
    return (views.calls(spark, sf).groupBy("phone_number", F.window("ts", "5 minutes", "1 minute").alias("w"))
            .agg(F.count("*").alias("calls")).select("phone_number", F.col("w.start").alias("window_start"), "calls"))
