"""Queries on score drift and latency."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as ops
from ..sources import views
from .evaluation import rounded
from .oracle_views import over
from .registry import query

BIN = " + ".join(f"(score >= {i} / 10)::int" for i in range(1, 10))
BINS = f"""
select b.bin, case when coalesce(e, 0) = 0 then 1e-6 else e / (select count(*) filter (is_baseline) from scores) end as e,
  case when coalesce(a, 0) = 0 then 1e-6 else a / (select count(*) filter (not is_baseline) from scores) end as a
from (select unnest(range(10)) as bin) b left join (select {BIN} as bin, count(*) filter (is_baseline) as e,
  count(*) filter (not is_baseline) as a from scores where score between 0 and 1 group by 1) c on b.bin = c.bin"""
SNAPS = """
select *, coalesce(2 * precision * hit_rate / nullif(precision + hit_rate, 0), 0) as f1 from (
  select date_trunc('day', ts)::timestamp as taken_at,
    coalesce(count(*) filter (label = 1 and score >= 0.1) / nullif(count(*) filter (label = 1), 0), 0) as hit_rate,
    coalesce(count(*) filter (label = 0 and score >= 0.1) / nullif(count(*) filter (label = 0), 0), 0) as fpr,
    coalesce(count(*) filter (label = 1 and score >= 0.1) / nullif(count(*) filter (score >= 0.1), 0), 0) as precision,
    count(*) as n_predictions from scores group by 1)"""
DELTAS = """
select *, hit_rate - first(hit_rate) over (order by taken_at) as hit_rate_delta,
  fpr - first(fpr) over (order by taken_at) as fpr_delta from snaps"""
PSI = f"""
select taken_at, sum((share - base) * ln(share / base)) as psi from (
  select *, first(share) over (partition by bin order by taken_at) as base from (
    select t.taken_at, b.bin, case when coalesce(n, 0) = 0 then 1e-6 else n / total end as share
    from (select date_trunc('day', ts)::timestamp as taken_at, count(*) as total from scores group by 1) t
    cross join (select unnest(range(10)) as bin) b
    left join (select date_trunc('day', ts)::timestamp as taken_at, {BIN} as bin, count(*) as n from scores group by 1, 2) c
      on c.taken_at = t.taken_at and c.bin = b.bin)) group by 1"""
REPORT = """
select taken_at, psi, hit_rate_delta, fpr_delta, severity, severity = 'CRITICAL' as requires_retraining,
  severity <> 'STABLE' as requires_investigation from (
  select *, case when psi > 0.25 or round(hit_rate_delta, 12) < -0.05 or round(fpr_delta, 12) > 0.02 then 'CRITICAL'
    when psi > 0.1 or abs(round(hit_rate_delta, 12)) > 0.02 then 'MODERATE' else 'STABLE' end as severity
  from deltas join psi using (taken_at))"""
ALL = {"snaps": SNAPS, "deltas": DELTAS, "psi": PSI, "report": REPORT}


@query("psi_bins", over("scores", """
select cast(bin as int) as bin, round(e, 6) as baseline_pct, round(a, 6) as current_pct,
  round((a - e) * ln(a / e), 6) as bin_psi from b""", b=BINS))
def psi_bins(spark, sf):
    return rounded(ops.psi_bins(views.scores(spark, sf), F.col("is_baseline")))


@query("psi_total", over("scores", """
select round(sum((a - e) * ln(a / e)), 6) as psi, sum((a - e) * ln(a / e)) >= 0.15 as drifted from b""", b=BINS))
def psi_total(spark, sf):
    return rounded(ops.psi_total(views.scores(spark, sf), F.col("is_baseline")))


@query("metric_deltas", over("scores", """
select taken_at, round(hit_rate, 6) as hit_rate, round(fpr, 6) as fpr, round(precision, 6) as precision, n_predictions,
  round(f1, 6) as f1, round(hit_rate_delta, 6) as hit_rate_delta, round(fpr_delta, 6) as fpr_delta from deltas""",
                            snaps=SNAPS, deltas=DELTAS))
def metric_deltas(spark, sf):
    return rounded(ops.metric_deltas(ops.snapshots(views.scores(spark, sf), F.date_trunc("day", "ts"), 0.1)))


@query("metric_trend", over("scores", """
select taken_at, round(hit_rate, 4) as hit_rate, round(fpr, 4) as fpr, round(precision, 4) as precision, n_predictions,
  round(f1, 4) as f1 from snaps order by taken_at desc limit 5""", snaps=SNAPS))
def metric_trend(spark, sf):
    return rounded(ops.metric_trend(ops.snapshots(views.scores(spark, sf), F.date_trunc("day", "ts"), 0.1)), 4)


@query("drift_report", over("scores", """
select taken_at, round(psi, 6) as psi, round(hit_rate_delta, 6) as hit_rate_delta, round(fpr_delta, 6) as fpr_delta,
  severity, requires_retraining, requires_investigation from report""", **ALL))
def drift_report(spark, sf):
    return rounded(ops.drift_report(views.scores(spark, sf), F.date_trunc("day", "ts"), 0.1))


@query("retrain_trigger", over("scores", """
select taken_at, round(psi, 6) as psi, round(hit_rate_delta, 6) as hit_rate_delta, 'CRITICAL_DRIFT' as reason
from report where requires_retraining order by taken_at limit 1""", **ALL))
def retrain_trigger(spark, sf):
    return rounded(ops.retrain_trigger(ops.drift_report(views.scores(spark, sf), F.date_trunc("day", "ts"), 0.1)))


@query("latency_percentiles", """
select count(value) as events, round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.95), 6) as p95,
  round(quantile_cont(value, 0.99), 6) as p99 from events""")
def latency_percentiles(spark, sf):
    return rounded(ops.latency_percentiles(views.events(spark, sf), "value"))


@query("latency_sla", """
select round(quantile_cont(value, 0.99), 6) as p99, 50::double as limit_ms, quantile_cont(value, 0.99) <= 50 as ok from events""")
def latency_sla(spark, sf):
    return rounded(ops.latency_sla(views.events(spark, sf), "value"))
