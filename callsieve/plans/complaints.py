"""Queries on complaints: cleaning, parsing, flags and features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import complaints as ops
from ..sources import views
from .oracle_views import over
from .registry import query

FAKES = "('000-000-0000', '555-555-5555', '111-111-1111', '999-999-9999')"
HOUR = r"""
select *, case when half = 'pm' and h <> 12 then h + 12 when half = 'am' and h = 12 then 0 else h end as h24 from (
  select *, try_cast(nullif(regexp_extract(tidy, '^(\d{1,2}):(\d{2})\s*(am|pm)?', 1), '') as int) as h,
    regexp_extract(tidy, '^(\d{1,2}):(\d{2})\s*(am|pm)?', 3) as half
  from (select *, replace(lower(trim(time_of_issue)), '.', '') as tidy from {source}))"""
CLEAN = f"""
select * exclude (tidy, h, half, h24), case when h24 between 0 and 23 then h24 end as parsed_hour,
  cast(isodow(parsed_date) - 1 as int) as day_of_week from (
  select *, case when d between timestamp '2015-01-01' and timestamp '2018-12-31' then d end as parsed_date
  from (select *, coalesce(try_strptime(date_of_issue, '%m/%d/%Y'), try_strptime(date_of_issue, '%Y-%m-%d')) as d
        from ({HOUR}) where caller_id is not null and caller_id not in {FAKES}))"""
FLAGS = """
select *, coalesce(parsed_hour >= 9 and parsed_hour < 17, false) as is_business,
  coalesce(parsed_hour >= 18 and parsed_hour < 22, false) as is_evening,
  coalesce(parsed_hour >= 22 or parsed_hour < 6, false) as is_night,
  coalesce(parsed_hour >= 8 and parsed_hour < 15 and day_of_week < 5, false) as is_school,
  coalesce(day_of_week >= 5, false) as is_weekend, parsed_hour is not null as has_hour,
  day_of_week is not null as has_weekday, coalesce(issue ilike '%robocall%', false) as is_robocall,
  coalesce(issue ilike '%telemarketing%', false) as is_telemarketing,
  coalesce(issue ilike '%indecency%', false) as is_indecency,
  coalesce(issue ilike '%cramming%' or issue ilike '%slamming%', false) as is_cramming, issue is not null as has_issue,
  coalesce(call_type = 'Prerecorded Voice', false) as is_prerecorded,
  coalesce(call_type = 'Abandoned Calls', false) as is_abandoned,
  coalesce(call_type in ('Live Voice', 'Autodialed Live Voice Call'), false) as is_live,
  call_type is not null as has_call_type, coalesce(method ilike '%voip%', false) as is_voip,
  coalesce(method ilike '%wireless%' or method ilike '%cell phone%', false) as is_wireless,
  method is not null as has_method, advertiser is not null as has_advertiser,
  coalesce(advertiser = caller_id, false) as advertiser_is_caller
from """
FEATURES = """
select caller_id, coalesce(sum(is_business::int) / nullif(sum(has_hour::int), 0), 0.5) as business_hour_ratio,
  coalesce(sum(is_evening::int) / nullif(sum(has_hour::int), 0), 0.2) as evening_ratio,
  coalesce(sum(is_night::int) / nullif(sum(has_hour::int), 0), 0.1) as night_ratio,
  coalesce(sum(is_school::int) / nullif(sum(has_hour::int), 0), 0.3) as school_hour_ratio,
  coalesce(sum(is_weekend::int) / nullif(sum(has_weekday::int), 0), 2 / 7) as weekend_ratio,
  max(is_robocall::int)::double as robocall_flag, max(is_telemarketing::int)::double as telemarketing_flag,
  coalesce(sum(is_prerecorded::int) / nullif(sum(has_call_type::int), 0), 0) as prerecorded_ratio,
  coalesce(sum(is_abandoned::int) / nullif(sum(has_call_type::int), 0), 0) as abandoned_call_ratio,
  coalesce(sum(is_live::int) / nullif(sum(has_call_type::int), 0), 0) as live_voice_ratio,
  max(is_indecency::int)::double as indecency_flag, max(is_cramming::int)::double as cramming_flag,
  count(distinct issue)::double as issue_diversity, ln(1 + count(*)) as complaint_count_log,
  (case when substr(regexp_replace(caller_id, '[^0-9]', '', 'g'), 1, 3)
      in ('800', '888', '877', '866', '855', '844', '833') then 1 else 0 end)::double as is_toll_free,
  coalesce(sum(is_voip::int) / nullif(sum(has_method::int), 0), 0) as is_voip,
  coalesce(sum(is_wireless::int) / nullif(sum(has_method::int), 0), 0) as is_wireless,
  least(count(distinct state) / 50.0, 1.0)::double as unique_states_norm,
  (case when date_diff('day', min(parsed_date), max(parsed_date)) > 0
     then count(*) / date_diff('day', min(parsed_date), max(parsed_date)) else count(*) end)::double as complaint_velocity,
  (case when sum(has_advertiser::int) > 0 and sum(advertiser_is_caller::int) < sum(has_advertiser::int)
     then 1 else 0 end)::double as multi_caller_flag
from ({flags}) group by caller_id"""
CLEANED = CLEAN.replace("{source}", "complaints")
FEATURES_SQL = FEATURES.replace("{flags}", f"{FLAGS} ({CLEANED})")
GOOD_FEATURES_SQL = FEATURES.replace("{flags}", f"{FLAGS} ({CLEAN.replace('{source}', 'known_good_complaints')})")
ROUNDED = ", ".join(f"round({n}, 6) as {n}" for n in ops.FEATURES)


def cleaned(spark, sf) -> DataFrame:
    return ops.clean(views.complaints(spark, sf))


def features(spark, sf) -> DataFrame:
    return ops.features(cleaned(spark, sf))


def good_features(spark, sf) -> DataFrame:
    return ops.features(ops.clean(views.known_good_complaints(spark, sf)))


def rounded(df: DataFrame, names: list[str] = ops.FEATURES) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in names], *[F.round(n, 6).alias(n) for n in names])


@query("complaints_clean", over("complaints", f"""
select ticket_id, caller_id, issue, parsed_date, parsed_hour, day_of_week,
  case when length(digits) >= 3 then substr(digits, 1, 3) end as area_code
from (select *, regexp_replace(caller_id, '[^0-9]', '', 'g') as digits from ({CLEANED}))"""))
def complaints_clean(spark, sf):
    return cleaned(spark, sf).select(
        "ticket_id", "caller_id", "issue", "parsed_date", "parsed_hour", "day_of_week", "area_code")


@query("complaint_row_flags", over("complaints", f"select ticket_id, {', '.join(ops.FLAGS)} from ({FLAGS} ({CLEANED}))"))
def complaint_row_flags(spark, sf):
    return ops.row_flags(cleaned(spark, sf)).select("ticket_id", *ops.FLAGS)


@query("complaint_features_20", over("complaints", f"select caller_id, {ROUNDED} from ({FEATURES_SQL})"))
def complaint_features_20(spark, sf):
    return rounded(features(spark, sf))


@query("feature_join_left", over("complaints", f"""
select caller_id, count(*) as complaints, count(distinct issue) as issues, count(distinct state) as states
from ({CLEANED}) group by 1"""))
def feature_join_left(spark, sf):
    return ops.diversity_counts(cleaned(spark, sf))


@query("complaints_to_calls", over("complaints", f"""
select 'fcc_' || lpad(cast(ticket_id as varchar), 8, '0') as call_id, trim(caller_id) as phone_number,
  'US' as caller_country, 'US' as callee_country,
  coalesce(method ilike '%robocall%' or method ilike '%prerecorded%' or method ilike '%auto-dialer%', false) as is_voip,
  true as reported_as_scam
from complaints where caller_id is not null and caller_id not in {FAKES}"""))
def complaints_to_calls(spark, sf):
    return ops.to_calls(views.complaints(spark, sf))


@query("parse_hour", over("complaints", f"""
select ticket_id, time_of_issue, case when h24 between 0 and 23 then h24 end as parsed_hour
from ({HOUR.replace('{source}', 'complaints')})"""))
def parse_hour(spark, sf):
    return views.complaints(spark, sf).select(
        "ticket_id", "time_of_issue", text.parse_hour(F.col("time_of_issue")).alias("parsed_hour"))


@query("parse_date", over("complaints", """
select ticket_id, d as parsed_date, cast(isodow(d) - 1 as int) as day_of_week, isodow(d) >= 6 as is_weekend
from (select ticket_id, try_strptime(date_of_issue, '%m/%d/%Y') as d from complaints)"""))
def parse_date(spark, sf):
    date = text.parse_date(F.col("date_of_issue"))
    return views.complaints(spark, sf).select(
        "ticket_id", date.alias("parsed_date"), F.weekday(date).alias("day_of_week"),
        (F.weekday(date) >= 5).alias("is_weekend"))


@query("area_code", over("complaints", """
select ticket_id, case when length(d) >= 3 then substr(d, 1, 3) end as area_code,
  coalesce(substr(d, 1, 3) in ('800', '888', '877', '866', '855', '844', '833'), false) as is_toll_free
from (select ticket_id, regexp_replace(caller_id, '[^0-9]', '', 'g') as d from complaints)"""))
def area_code(spark, sf):
    number = F.col("caller_id")
    return views.complaints(spark, sf).select(
        "ticket_id", text.area_code(number).alias("area_code"), text.is_toll_free(number).alias("is_toll_free"))


@query("feature_vector", over("complaints", f"""
select caller_id, unnest(range(20)) as pos, round(unnest([{', '.join(ops.FEATURES)}]), 6) as value
from ({FEATURES_SQL})"""))
def feature_vector(spark, sf):
    table = features(spark, sf)
    return table.select("caller_id", F.posexplode(ops.feature_vector(table, ops.FEATURES)).alias("pos", "value")).select(
        "caller_id", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


@query("vector_length_check", """
select vec_id, len(v) as n_features,
  case when len(v) <> 64 then 'Expected 64 features, got ' || cast(len(v) as varchar) end as error
from (select vec_id, case when vec_id % 9 = 0 then embedding[1:60] else embedding end as v from embeddings)""")
def vector_length_check(spark, sf):
    vector = F.when(F.col("vec_id") % 9 == 0, F.slice("embedding", 1, 60)).otherwise(F.col("embedding"))
    return views.table(spark, sf, "embeddings").select("vec_id", vector.alias("v")).select(
        "vec_id", F.size("v").cast("long").alias("n_features"), ops.vector_check(F.col("v"), 64).alias("error"))
