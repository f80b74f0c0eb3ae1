"""Queries on A/B experiments."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from ..operators import abtest as ops
from ..sources import views
from .evaluation import rounded
from .oracle_views import over
from .registry import query

ARMS = """
select experiment, arm, n, hit_rate, false_positive_rate, reporter_score_avg, precision,
  coalesce(2 * precision * hit_rate / nullif(precision + hit_rate, 0), 0) as f1
from (select *, coalesce(hit_rate / nullif(hit_rate + false_positive_rate, 0), 0) as precision from (
  select experiment, arm, count(*) as n, avg(hit) as hit_rate, avg(false_alarm) as false_positive_rate,
    avg(reporter_score) as reporter_score_avg from arms group by 1, 2))"""
Z_ALPHA, Z_BETA = NormalDist().inv_cdf(0.975), NormalDist().inv_cdf(0.8)
LIFTS = [0.0, 0.5, 1.0, 2.0, -3.0, 25.0]


def phi(z: str) -> str:
    """Normal distribution function by Simpson's rule over 1,000 steps, apart from the operator's approximation."""
    step = f"(least(abs({z}), 9) / 1000)"
    area = f"list_sum(list_transform(range(0, 1001), lambda i: (case when i in (0, 1000) then 1 when i % 2 = 1 then 4 else 2 end) * exp(-i * i * {step} * {step} / 2)))"
    return f"(0.5::double + sign({z}) * {step} / 3 * {area} / sqrt(2 * pi()))"


PAIRS = """
select c.experiment, m.metric, c.n as n1, t.n as n2,
  case m.metric when 'hit_rate' then c.hit_rate else c.false_positive_rate end as p1,
  case m.metric when 'hit_rate' then t.hit_rate else t.false_positive_rate end as p2
from am c join am t on c.experiment = t.experiment and c.arm = 'control' and t.arm = 'treatment'
cross join (select unnest(['hit_rate', 'false_positive_rate']) as metric) m"""
STEP = """
select *, p2 - p1 as lift, (p2 - p1) / nullif(sqrt(pool * (1 - pool) * (1 / n1 + 1 / n2)), 0) as z,
  sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2) as spread,
  abs(p2 - p1) / sqrt(2 * ((p1 + p2) / 2) * (1 - (p1 + p2) / 2) / least(n1, n2)) as pz
from (select *, (p1 * n1 + p2 * n2) / (n1 + n2) as pool from pairs)"""
TESTS = f"""
select experiment, metric, p1 as control_value, p2 as treatment_value, lift as absolute_lift,
  lift / p1 * 100 as relative_lift_pct, z, 2 * (1 - {phi('abs(z)')}) as p_value, lift - {Z_ALPHA!r} * spread as ci_lower,
  lift + {Z_ALPHA!r} * spread as ci_upper, lift / sqrt((p1 * (1 - p1) + p2 * (1 - p2)) / 2) as cohen_d,
  {phi(f'(pz - {Z_ALPHA!r}::double)')} as power from step"""
JUDGED = """
select *, case when abs(cohen_d) < 0.2 then 'negligible' when abs(cohen_d) < 0.5 then 'small'
    when abs(cohen_d) < 0.8 then 'medium' else 'large' end as effect,
  p_value < 0.05 as is_significant, abs(cohen_d) >= 0.2 as is_practical,
  case when p_value < 0.05 and abs(cohen_d) >= 0.2 and absolute_lift > 0 then 'SHIP'
    when p_value < 0.05 and abs(cohen_d) < 0.2 then 'HOLD' when p_value >= 0.05 and power < 0.5 then 'EXTEND'
    when p_value >= 0.05 then 'STOP' else 'REVIEW' end as recommendation from tests"""
ALL = {"am": ARMS, "pairs": PAIRS, "step": STEP, "tests": TESTS, "judged": JUDGED}
FIGURES = ["control_value", "treatment_value", "absolute_lift", "relative_lift_pct", "z", "p_value", "ci_lower", "ci_upper",
           "cohen_d", "power"]


def tests(spark, sf):
    return ops.z_tests(ops.arm_metrics(views.arms(spark, sf)))


@query("ab_arms", over("arms", """
select experiment, arm, n, round(hit_rate, 6) as hit_rate, round(false_positive_rate, 6) as false_positive_rate,
  round(reporter_score_avg, 6) as reporter_score_avg, round(precision, 6) as precision, round(f1, 6) as f1 from am""",
                      am=ARMS))
def ab_arms(spark, sf):
    return rounded(ops.arm_metrics(views.arms(spark, sf)))


@query("ab_ztest", over("arms", f"""
select experiment, metric, {', '.join(f'round({c}, 6) as {c}' for c in FIGURES)}, effect, is_significant, is_practical,
  recommendation from judged""", **ALL))
def ab_ztest(spark, sf):
    return rounded(tests(spark, sf))


@query("ab_assessment", over("arms", """
select experiment, hit_up, fpr_up, case when hit_up and fpr_up then 'CHECK_TRADEOFF' when hit_up then 'SHIP' else 'HOLD' end
  as assessment
from (select experiment, bool_or(metric = 'hit_rate' and is_significant and absolute_lift > 0) as hit_up,
  bool_or(metric <> 'hit_rate' and is_significant and absolute_lift > 0) as fpr_up from judged group by 1)""", **ALL))
def ab_assessment(spark, sf):
    return ops.assessment(tests(spark, sf))


@query("ab_compare", over("arms", """
select a.metric, round(a.absolute_lift, 6) as absolute_lift_a, round(a.p_value, 6) as p_value_a,
  round(a.cohen_d, 6) as cohen_d_a, round(b.absolute_lift, 6) as absolute_lift_b, round(b.p_value, 6) as p_value_b,
  round(b.cohen_d, 6) as cohen_d_b, round(b.absolute_lift - a.absolute_lift, 6) as incremental_lift
from judged a join judged b on a.metric = b.metric and a.experiment = 'exp-1' and b.experiment = 'exp-2'""", **ALL))
def ab_compare(spark, sf):
    return rounded(ops.compare(tests(spark, sf), "exp-1", "exp-2"))


@query("ab_sample_size", over("arms", f"""
select experiment, round(baseline, 6) as baseline, lift_pp, lift_pp / 100 as mde, n_per_arm, 2 * n_per_arm as total from (
  select *, greatest(cast(ceil(pow({Z_ALPHA!r}::double * sqrt(2 * pm * (1 - pm)) + {Z_BETA!r}::double
    * sqrt(p1 * (1 - p1) + p2 * (1 - p2)), 2) / pow(p2 - p1, 2)) as bigint), 100) as n_per_arm
  from (select *, (p1 + p2) / 2 as pm from (
    select experiment, hit_rate as baseline, lift_pp, hit_rate as p1, least(1 - 1e-6, hit_rate + e) as p2
    from am, (select l::double as lift_pp, case when abs(l / 100) > 1e-6 then abs(l / 100) else 0.01 end as e
              from (select unnest({LIFTS}) as l)) where arm = 'control')))""", am=ARMS))
def ab_sample_size(spark, sf):
    plans = ops.arm_metrics(views.arms(spark, sf)).filter("arm = 'control'").select(
        "experiment", F.col("hit_rate").alias("baseline"), F.explode(F.array(*[F.lit(x) for x in LIFTS])).alias("lift_pp"))
    return rounded(ops.sample_size(plans))
