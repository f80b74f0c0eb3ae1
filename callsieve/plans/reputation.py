"""Queries on reporters, reports and the blacklist."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scoring
from ..operators import burst, skew
from ..operators import reputation as ops
from ..session import cut_lineage
from ..sources import views
from .complaints import FEATURES_SQL, features
from .evaluation import rounded
from .oracle_views import over
from .registry import query

SCORE = """greatest(0, least(1, 0.6::double * alpha / (alpha + beta) + least(0.2::double, 0.04::double * ln(1 + total_reports))
  - least(0.15::double, 0.03::double * {burst}) - case when geo_flag then 0.1::double else 0 end))"""
WEIGHT = """(case when round({s}, 9) >= 0.85 then 1.0 when round({s}, 9) >= 0.65 then 0.65
  when round({s}, 9) >= 0.4 then 0.35 else 0.1 end)::double"""
TIER = """case when round({s}, 9) >= 0.85 then 'tier_4' when round({s}, 9) >= 0.65 then 'tier_3'
  when round({s}, 9) >= 0.4 then 'tier_2' else 'tier_1' end"""
DECIDE = """case when {s} >= 0.85 then 'BLOCK' when {s} >= 0.5 then 'REVIEW' when {s} >= 0.15 then 'SUSPECT' else 'SAFE' end"""
ODD = "registered_country <> report_country and report_country not in ('TW', 'HK', 'SG')"
REPUTATION = f"""
select *, {SCORE.format(burst=0)} as score from (
  select u.user_id, 2.0::double + coalesce(r, 0) as alpha, 2.0::double + coalesce(w, 0) as beta,
    coalesce(r, 0) + coalesce(w, 0) as total_reports, coalesce(g, false) as geo_flag
  from reporters u
  left join (select user_id, count(*) filter (was_correct) as r, count(*) filter (not was_correct) as w
             from validations group by 1) v on v.user_id = u.user_id
  left join (select user_id, bool_or({ODD}) as g from reports group by 1) x on x.user_id = u.user_id)"""
PEOPLE = "reporters validations reports"


def table(spark, sf):
    return ops.reputation_table(views.reporters(spark, sf), views.validations(spark, sf), views.reports(spark, sf))


@query("reputation_score", over(PEOPLE, f"""
select user_id, alpha, beta, total_reports, geo_flag, round(score, 6) as score, {TIER.format(s='score')} as tier,
  {WEIGHT.format(s='score')} as report_weight from r""", r=REPUTATION))
def reputation_score(spark, sf):
    return rounded(table(spark, sf))


@query("leaderboard", over(PEOPLE, f"""
select cast(row_number() over (order by round(score, 9) desc, user_id) as int) as rank, user_id, {TIER.format(s='score')} as tier,
  round(score, 3) as score, total_reports, round(alpha / (alpha + beta), 3) as accuracy from r
order by round(score, 9) desc, user_id limit 10""", r=REPUTATION))
def leaderboard(spark, sf):
    return ops.leaderboard(table(spark, sf))


@query("beta_running", over("validations", """
select seq, user_id, 2.0::double + sum(was_correct::int) over w as alpha, 2.0::double + sum((not was_correct)::int) over w as beta,
  count(*) over w as total_reports
from validations window w as (partition by user_id order by t, seq rows unbounded preceding)"""))
def beta_running(spark, sf):
    return ops.beta_running(views.validations(spark, sf))


@query("geo_flag_running", over("reports", f"""
select report_seq, user_id, bool_or({ODD}) over (partition by user_id order by t, report_seq rows unbounded preceding)
  as geo_flag from reports"""))
def geo_flag_running(spark, sf):
    return ops.geo_flag_running(views.reports(spark, sf))


@query("asof_reputation", over(PEOPLE, f"""
select report_seq, user_id, alpha, beta, total_reports, round({SCORE.format(burst=0)}, 6) as score from (
  select r.report_seq, r.user_id, false as geo_flag, 2.0::double + count(*) filter (v.was_correct) as alpha,
    2.0::double + count(*) filter (not v.was_correct) as beta, count(v.seq) as total_reports
  from reports r left join validations v
    on v.user_id = r.user_id and (v.t < r.t or v.t = r.t and v.seq < r.report_seq) group by 1, 2)"""))
def asof_reputation(spark, sf):
    dated = ops.reputation_as_of(views.reports(spark, sf), views.validations(spark, sf))
    score = scoring.reputation(F.col("alpha"), F.col("beta"), F.col("total_reports"), F.lit(0), F.lit(False))
    return dated.select("report_seq", "user_id", "alpha", "beta", "total_reports", F.round(score, 6).alias("score"))


@query("reports_known_users", over(PEOPLE, """
select report_seq, user_id, phone_number from reports where user_id in (select user_id from reporters)"""))
def reports_known_users(spark, sf):
    return ops.known_reports(views.reports(spark, sf), views.reporters(spark, sf)).select("report_seq", "user_id", "phone_number")


@query("reports_unknown_users", over(PEOPLE, """
select report_seq, user_id, 'Unknown user' as reason from reports where user_id not in (select user_id from reporters)"""))
def reports_unknown_users(spark, sf):
    return ops.unknown_reports(views.reports(spark, sf), views.reporters(spark, sf)).select("report_seq", "user_id", "reason")


@query("reports_default_users", over(PEOPLE, """
select r.report_seq, r.user_id, coalesce(u.registered_country, 'TW') as registered_country, 2.0::double as alpha,
  2.0::double as beta, u.user_id is null as auto_registered from reports r left join reporters u on u.user_id = r.user_id"""))
def reports_default_users(spark, sf):
    return ops.default_reports(views.reports(spark, sf), views.reporters(spark, sf)).select(
        "report_seq", "user_id", "registered_country", "alpha", "beta", "auto_registered")


@query("report_sessions", over("reports", """
select user_id, session, round(min(t), 4) as session_start, round(max(t), 4) as session_end, count(*) as reports from (
  select *, cast(sum(coalesce((t - p > 300)::int, 1)) over (partition by user_id order by t, report_seq
    rows unbounded preceding) as bigint) as session
  from (select *, lag(t) over (partition by user_id order by t, report_seq) as p from reports)) group by 1, 2"""))
def report_sessions(spark, sf):
    return rounded(burst.report_sessions(views.reports(spark, sf)), 4)


def fold(source: str) -> dict[str, str]:
    """The burst rule as a row-by-row recursion."""
    return {
        "lined": f"select *, row_number() over (partition by user_id order by t, report_seq) as rn from {source}",
        "walk": """
select user_id, rn, report_seq, t as last_t, 1 as cnt, true as accepted from lined where rn = 1
union all
select o.user_id, o.rn, o.report_seq, case when o.t - w.last_t > 300 or w.cnt < 10 then o.t else w.last_t end,
  case when o.t - w.last_t > 300 then 1 when w.cnt < 10 then w.cnt + 1 else w.cnt end, o.t - w.last_t > 300 or w.cnt < 10
from walk w join lined o on o.user_id = w.user_id and o.rn = w.rn + 1""",
    }


@query("burst_throttle", over("reports", """
select report_seq, user_id, accepted, cast(cnt as bigint) as burst_count from walk""", **fold("reports")))
def burst_throttle(spark, sf):
    return burst.burst_throttle(views.reports(spark, sf)).select("report_seq", "user_id", "accepted", "burst_count")


@query("report_ids", over("reports", """
select report_seq, 'RPT-' || lpad(cast(row_number() over (order by report_seq) as varchar), 6, '0') as report_id from reports"""))
def report_ids(spark, sf):
    return ops.report_ids(views.reports(spark, sf))


RUNNING = """
select *, round(least(1.0, sum(user_weight) over w / count(*) over w), 9) as weighted_score, count(*) over w as number_reports
from weighted_reports window w as (partition by phone_number order by report_seq rows unbounded preceding)"""


@query("running_consensus", over("weighted_reports", f"""
select report_seq, phone_number, number_reports, round(weighted_score, 6) as weighted_score,
  case when weighted_score >= 0.85 and number_reports < 3 then 'REVIEW' else {DECIDE.format(s='weighted_score')} end as decision
from r""", r=RUNNING))
def running_consensus(spark, sf):
    return rounded(ops.running_consensus(views.weighted_reports(spark, sf)).select(
        "report_seq", "phone_number", "number_reports", "weighted_score", "decision"))


def dominant(source: str) -> str:
    """Category with the largest running weight at each row, by comparing all categories at all rows."""
    return f"""
select report_seq, arg_max(category, (s, -first_seq)) as dominant_category from (
  select r.report_seq, c.scam_category as category, round(sum(c.user_weight), 9) as s, min(c.report_seq) as first_seq
  from {source} r join {source} c on c.phone_number = r.phone_number and c.report_seq <= r.report_seq
  group by 1, 2) group by 1"""


@query("running_dominant_category", over("weighted_reports", "select * from d", d=dominant("weighted_reports")))
def running_dominant_category(spark, sf):
    return ops.running_dominant_category(views.weighted_reports(spark, sf)).select("report_seq", "dominant_category")


CONSENSUS = f"""
select phone_number, reports, weighted_score, dominant_category, {DECIDE.format(s='weighted_score')} as decision from (
  select phone_number, cast(sum(n) as bigint) as reports, round(least(1.0, sum(w) / sum(n)), 9) as weighted_score,
    arg_max(scam_category, (round(w, 9), -f)) as dominant_category
  from (select phone_number, scam_category, sum(user_weight) as w, count(*) as n, min(report_seq) as f
        from weighted_reports group by 1, 2) group by 1)"""


@query("phone_consensus", over("weighted_reports", """
select phone_number, reports, round(weighted_score, 6) as weighted_score, dominant_category, decision from c""", c=CONSENSUS))
def phone_consensus(spark, sf):
    return rounded(ops.phone_consensus(views.weighted_reports(spark, sf)))


@query("blacklist_candidates", over("weighted_reports", """
select phone_number, reports, round(weighted_score, 6) as weighted_score, dominant_category, decision from c
where decision = 'BLOCK'""", c=CONSENSUS))
def blacklist_candidates(spark, sf):
    return rounded(ops.blacklist_candidates(ops.phone_consensus(views.weighted_reports(spark, sf))))


DECISIONS = fold("(select * from reports where user_id in (select user_id from reporters))") | {
    "acc": f"""
select r.*, w.cnt as burst_count, bool_or({ODD}) over (partition by r.user_id order by r.t, r.report_seq
  rows unbounded preceding) as geo_flag from reports r join walk w on w.report_seq = r.report_seq where w.accepted""",
    "dated": """
select a.*, 2.0::double + coalesce(k.r, 0) as alpha, 2.0::double + coalesce(k.w, 0) as beta,
  coalesce(k.r, 0) + coalesce(k.w, 0) as total_reports
from acc a left join (
  select a.report_seq, count(*) filter (v.was_correct) as r, count(*) filter (not v.was_correct) as w
  from acc a join validations v on v.user_id = a.user_id and (v.t < a.t or v.t = a.t and v.seq < a.report_seq)
  group by 1) k on k.report_seq = a.report_seq""",
    "rated": f"select *, {SCORE.format(burst='burst_count')} as reputation from dated",
    "weighed": f"select *, {WEIGHT.format(s='reputation')} as user_weight from rated",
    "judged": """
select *, round(least(1.0, sum(user_weight) over w / count(*) over w), 9) as weighted_score, count(*) over w as number_reports
from weighed window w as (partition by phone_number order by report_seq rows unbounded preceding)""",
    "dom": dominant("weighed"),
}


@query("report_decisions", over(PEOPLE, f"""
select report_seq, user_id, phone_number, 'accepted' as status, cast(burst_count as bigint) as burst_count, geo_flag,
  round(reputation, 6) as reputation, user_weight, round(weighted_score, 6) as weighted_score, number_reports,
  dominant_category,
  case when weighted_score >= 0.85 and number_reports < 3 then 'REVIEW' else {DECIDE.format(s='weighted_score')} end as decision
from judged join dom using (report_seq)
union all
select report_seq, user_id, phone_number, case when user_id in (select user_id from reporters) then 'throttled' else 'error' end,
  null, null, null, null, null, null, null, null
from reports where report_seq not in (select report_seq from acc)""", **DECISIONS))
def report_decisions(spark, sf):
    return rounded(ops.report_decisions(views.reports(spark, sf), views.validations(spark, sf), views.reporters(spark, sf)))


def number_scores(spark, sf):
    """A probability per number from its call record."""
    risk = skew.number_risk(skew.number_sums(views.calls(spark, sf)))
    proba = F.round(F.least(F.lit(1.0), F.col("scam_rate") + 0.1 * F.col("voip_ratio")), 9)
    return risk.select("phone_number", proba.alias("spam_proba"), "call_count")


NUMBER_SCORES = """
select phone_number, count(*) as call_count, round(least(1.0, count(*) filter (reported_as_scam) / count(*)
  + 0.1::double * (count(*) filter (is_voip) / count(*))), 9) as spam_proba from calls group by 1"""


@query("high_conf_top5", over("calls", """
select phone_number, round(spam_proba, 6) as spam_proba, call_count from n where spam_proba >= 0.8
order by n.spam_proba desc, phone_number limit 5""", n=NUMBER_SCORES))
def high_conf_top5(spark, sf):
    return rounded(ops.high_confidence(number_scores(spark, sf)))


@query("score_lookup", over("calls complaints", f"""
select c.call_id, c.phone_number, round(n.spam_proba, 6) as spam_proba, round(f.complaint_velocity, 6) as complaint_velocity
from calls c join n on n.phone_number = c.phone_number
left join ({FEATURES_SQL}) f on f.caller_id = case when c.phone_number like 'center-%'
  then '800-555-000' || right(c.phone_number, 1) end""", n=NUMBER_SCORES))
def score_lookup(spark, sf):
    known = features(spark, sf).select(F.col("caller_id").alias("number"), "complaint_velocity")
    number = F.when(F.col("phone_number").like("center-%"), F.concat(F.lit("800-555-000"), F.substring("phone_number", -1, 1)))
    # One row per number first, then the calls meet that small table once.
    lookup = number_scores(spark, sf).withColumn("number", number).join(known, "number", "left").select(
        "phone_number", "spam_proba", "complaint_velocity")
    return rounded(views.calls(spark, sf).select("call_id", "phone_number").join(lookup, "phone_number"))


REPORTERS = [1, 2, 4, 5]
CATEGORIES = ["investment", "customs", "romance", "impersonation"]


@query("model_driven_reports")
def model_driven_reports(spark, sf):
    top = ops.high_confidence(number_scores(spark, sf))
    last = views.validations(spark, sf).agg(F.max("t").alias("t"), F.max("seq").alias("s"))
    sent = top.select("phone_number", F.posexplode(F.array(*[F.lit(r).cast("long") for r in REPORTERS])).alias("i", "user_id"))
    reports = sent.select(
        (last.select("s").scalar() + 1 + F.crc32("phone_number") * len(REPORTERS) + F.col("i")).alias("report_seq"),
        "user_id", "phone_number",
        F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), F.col("i") % len(CATEGORIES) + 1).alias("scam_category"),
        (last.select("t").scalar() + 1 + F.col("i")).alias("t"), F.lit("TW").alias("report_country"),
        F.lit("TW").alias("registered_country"))
    return rounded(ops.report_decisions(cut_lineage(reports), views.validations(spark, sf), views.reporters(spark, sf)))


STREAM = "select 'num-' || cast(user_id as varchar) as phone_number, round(max(score), 9) as probability from scores group by 1"


@query("blacklist_merged", over("weighted_reports scores", """
select coalesce(c.phone_number, s.phone_number) as phone_number, round(weighted_score, 6) as weighted_score,
  round(probability, 6) as probability, c.phone_number is not null as by_consensus, s.phone_number is not null as by_stream,
  (c.phone_number is not null)::int + (s.phone_number is not null)::int as entries
from (select * from c where decision = 'BLOCK') c
full join (select * from s where probability >= 0.5) s on s.phone_number = c.phone_number""", c=CONSENSUS, s=STREAM))
def blacklist_merged(spark, sf):
    listed = ops.blacklist_candidates(ops.phone_consensus(views.weighted_reports(spark, sf)))
    stream = (views.scores(spark, sf).groupBy(F.concat(F.lit("num-"), "user_id").alias("phone_number"))
              .agg(F.max("score").alias("probability")).filter("probability >= 0.5"))
    return rounded(ops.merged_blacklist(listed, stream))


@query("service_stats", over("scores weighted_reports", """
select count(*) as total_predictions, count(*) filter (event_id % 3 = 0) as total_model_predictions,
  (select count(*) from weighted_reports) as total_reports, (select count(*) from c where decision = 'BLOCK')
  as blacklisted_numbers, round(avg(score * 100), 3) as avg_latency_ms from scores""", c=CONSENSUS))
def service_stats(spark, sf):
    predictions = views.scores(spark, sf).select((F.col("event_id") % 3 == 0).alias("by_model"), (F.col("score") * 100).alias("latency_ms"))
    reports = views.weighted_reports(spark, sf)
    return ops.service_stats(predictions, reports, ops.blacklist_candidates(ops.phone_consensus(reports)))
