"""Behaviour features per number."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import behavior as ops
from ..sources import views
from .oracle_views import over
from .registry import query

BASE = """
select phone_number, count(*) as n, avg(call_duration_sec) as avg_duration_sec, max(call_duration_sec) as max_duration_sec,
  min(call_duration_sec) as min_duration_sec, stddev_pop(call_duration_sec) as duration_std,
  avg((call_duration_sec < 10)::int) as short_call_ratio, avg(is_voip::int) as voip_ratio,
  count(distinct callee_country) as unique_countries, avg((callee_country <> 'TW')::int) as cross_border_ratio,
  avg((callee_country in ('MM', 'KH', 'LA', 'TH', 'NG', 'GH'))::int) as high_risk_country_ratio,
  count(distinct callee_number) as unique_callees, count(distinct callee_number) / count(*) as fan_out_ratio,
  count(distinct device_fp) as unique_devices, avg((hour(ts) >= 22 or hour(ts) < 6)::int) as night_call_ratio,
  avg((isodow(ts) >= 6)::int) as weekend_ratio, avg((sms_content_hash <> '')::int) as sms_to_call_ratio
from calls group by 1"""
COUNTRY = """
select phone_number, -sum(p * log2(p)) as country_entropy, arg_min(callee_country, (-c, f)) as primary_country
from (select *, c / sum(c) over (partition by phone_number) as p from
  (select phone_number, callee_country, count(*) as c, min(call_id) as f from calls group by 1, 2)) group by 1"""
CALLEE = """
select phone_number, max(c) as max_calls_to_single, avg((c > 1)::int) as repeat_callee_ratio
from (select phone_number, callee_number, count(*) as c from calls group by 1, 2) group by 1"""
HOURS = """
select phone_number, avg(c) as calls_per_hour_avg, max(c) as calls_per_hour_max
from (select phone_number, date_trunc('hour', ts) as h, count(*) as c from calls group by 1, 2) group by 1"""
PEAK = """
select phone_number, arg_min(h, (-c, h)) as peak_hour
from (select phone_number, hour(ts) as h, count(*) as c from calls group by 1, 2) group by 1"""
BURST = """
select phone_number, max(c) as burst_count_5min from (select phone_number, count(*) over (partition by phone_number
  order by ts range between interval 299999999 microsecond preceding and current row) as c from calls) group by 1"""
GAPS = """
select phone_number, coalesce(avg(g), 0) as avg_time_between_calls_sec, coalesce(stddev_pop(g), 0) as call_regularity_std,
  count(*) filter (changed) as device_switch_count
from (select phone_number, (epoch_us(ts) - lag(epoch_us(ts)) over w) / 1000000 as g, device_fp <> lag(device_fp) over w
        as changed from calls window w as (partition by phone_number order by ts, call_id)) group by 1"""
RECIPROCAL = """
select a.phone_number, avg((b.phone_number is not null)::int) as reciprocity_ratio
from (select distinct phone_number, callee_number from calls) a
left join (select distinct phone_number, callee_number from calls) b
  on a.phone_number = b.callee_number and a.callee_number = b.phone_number group by 1"""
REPORTED = """
select phone_number, count(*) as total_reports, sum(weight) as weighted_report_score,
  count(*) / greatest(floor((floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 86400), 1) as report_density_per_day,
  count(distinct reporter) as unique_reporters, count(distinct scam_category) as category_diversity
from calls where reported_as_scam group by 1"""
COLUMNS = ", ".join(f"round(coalesce({n}, 0)::double, 6) as {n}" for n in ops.FEATURES)
JOINS = " ".join(f"left join ({sql}) using (phone_number)" for sql in
                 (COUNTRY, CALLEE, HOURS, PEAK, BURST, GAPS, RECIPROCAL, REPORTED))


@query("behavior_features_31", over("calls", f"select phone_number, primary_country, {COLUMNS} from ({BASE}) {JOINS}"))
def behavior_features_31(spark, sf):
    calls = views.calls(spark, sf)
    reports = calls.filter("reported_as_scam")
    table = ops.behavior_features(calls, reports)
    return table.select("phone_number", "primary_country", *[F.round(n, 6).alias(n) for n in ops.FEATURES])


# The documented order of the vector, written down apart from the operator.
ORDER = """
calls_per_hour_avg calls_per_hour_max peak_hour night_call_ratio burst_count_5min avg_time_between_calls_sec
call_regularity_std weekend_ratio avg_duration_sec max_duration_sec min_duration_sec short_call_ratio duration_std
unique_countries cross_border_ratio country_entropy high_risk_country_ratio voip_ratio unique_devices
device_switch_count sms_to_call_ratio unique_callees reciprocity_ratio fan_out_ratio repeat_callee_ratio
max_calls_to_single total_reports weighted_report_score report_density_per_day unique_reporters category_diversity""".split()


@query("behavior_vector_31", over("calls", "select phone_number, u.* from f, unnest([" + ", ".join(
    f"{{'position': {i}, 'name': '{n}', 'value': {n}}}" for i, n in enumerate(ORDER, 1)) + "]) t(u)",
    f=f"select phone_number, {COLUMNS} from ({BASE}) {JOINS}"))
def behavior_vector_31(spark, sf):
    calls = views.calls(spark, sf)
    table = ops.behavior_features(calls, calls.filter("reported_as_scam"))
    return ops.vector_positions(table).withColumn("value", F.round("value", 6))
