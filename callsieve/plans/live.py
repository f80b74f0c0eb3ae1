"""Batch twins of the streaming blacklist."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import live as ops
from ..operators.complaints import FEATURES
from ..sources import views
from .oracle_views import over
from .registry import query

COUNTS = """
select call_id, phone_number, ts, count(*) over w as n, sum(is_voip::int) over w / count(*) over w as voip,
  sum((call_duration_sec < 30)::int) over w / count(*) over w as short,
  sum((hour(ts) between 9 and 16)::int) over w / count(*) over w as business,
  sum((hour(ts) between 18 and 21)::int) over w / count(*) over w as evening,
  sum((hour(ts) >= 22 or hour(ts) < 6)::int) over w / count(*) over w as night,
  sum((hour(ts) between 8 and 14)::int) over w / count(*) over w as school,
  sum((isodow(ts) >= 6)::int) over w / count(*) over w as weekend, count(distinct caller_country) over w as countries
from calls window w as (partition by phone_number order by ts, call_id rows unbounded preceding)"""
KNOWN = {
    "business_hour_ratio": "business", "evening_ratio": "evening", "night_ratio": "night", "school_hour_ratio": "school",
    "weekend_ratio": "weekend", "prerecorded_ratio": "short", "abandoned_call_ratio": "short", "live_voice_ratio": "1 - short",
    "is_voip": "voip", "unique_states_norm": "least(countries / 10, 1)",
}
SCORED = """
select call_id, phone_number, ts, n as total_calls,
  round(0.4::double * night + 0.4::double * voip + 0.2::double * short, 4) as probability from c"""
GATED = "select * from s where probability >= 0.5 and total_calls >= 5"


@query("stream_features_running", over("calls", f"""
select call_id, phone_number, n as total_calls,
  {', '.join(f"round({KNOWN.get(n, '0')}, 6)::double as {n}" for n in FEATURES)} from c""", c=COUNTS))
def stream_features_running(spark, sf):
    return ops.running_features(views.calls(spark, sf)).select(
        "call_id", "phone_number", "total_calls", *[F.round(n, 6).alias(n) for n in FEATURES])


def gated(spark, sf):
    scored = ops.running_features(views.calls(spark, sf)).select(
        "call_id", "phone_number", "ts", "total_calls", ops.rule_score().alias("probability"))
    return ops.gate(scored, 0.5)


@query("blacklist_gate", over("calls", "select call_id, phone_number, total_calls, probability from g", c=COUNTS, s=SCORED, g=GATED))
def blacklist_gate(spark, sf):
    return gated(spark, sf).drop("ts")


@query("blacklist_write_dedup", over("calls", """
select l.call_id, l.phone_number, l.total_calls, l.probability from walk join l using (phone_number, rn) where walk.written""",
                                    c=COUNTS, s=SCORED, g=GATED, l="""
select *, row_number() over (partition by phone_number order by ts, call_id) as rn from g""", walk="""
select phone_number, rn, probability as last_p, true as written from l where rn = 1
union all
select l.phone_number, l.rn, case when abs(l.probability - w.last_p) > 0.01::double then l.probability else w.last_p end,
  abs(l.probability - w.last_p) > 0.01::double
from walk w join l on l.phone_number = w.phone_number and l.rn = w.rn + 1"""))
def blacklist_write_dedup(spark, sf):
    return ops.write_dedup(gated(spark, sf)).drop("ts")
