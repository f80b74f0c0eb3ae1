"""Queries that evaluate scored tables, and split them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scoring
from ..operators import evaluation as ops
from ..operators import sampling
from ..sources import views
from .oracle_views import over
from .registry import query

CUM = """
select score, pos, neg, cast(sum(pos) over (order by score desc) as bigint) as tp,
  cast(sum(neg) over (order by score desc) as bigint) as fp, sum(pos) over () as p, sum(neg) over () as n
from (select score, sum(label) as pos, sum(1 - label) as neg from scores group by 1)"""
PR = "select score as threshold, tp / (tp + fp) as precision, tp / p as recall from cum"
THRESHOLD = 0.1


def with_cum(body: str, **extra: str) -> str:
    return over("scores", body, cum=CUM, **extra)


def rounded(df, digits: int = 6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("pr_curve", with_cum("""
select round(threshold, 6) as threshold, round(precision, 6) as precision, round(recall, 6) as recall from pr
union all select null, 1, 0""", pr=PR))
def pr_curve(spark, sf):
    return rounded(ops.pr_curve(views.scores(spark, sf)))


@query("roc_curve", with_cum("""
select round(score, 6) as threshold, round(fp / n, 6) as fpr, round(tp / p, 6) as tpr from cum union all select null, 0, 0"""))
def roc_curve(spark, sf):
    return rounded(ops.roc_curve(views.scores(spark, sf)))


@query("roc_auc", over("scores", """
select round((sum(r) filter (label = 1) - count(*) filter (label = 1) * (count(*) filter (label = 1) + 1) / 2)
  / (count(*) filter (label = 1) * count(*) filter (label = 0)), 6) as roc_auc
from (select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2 as r from scores)"""))
def roc_auc(spark, sf):
    return rounded(ops.roc_auc(views.scores(spark, sf)))


@query("average_precision", with_cum("select round(sum(pos / p * tp / (tp + fp)), 6) as average_precision from cum"))
def average_precision(spark, sf):
    return rounded(ops.average_precision(views.scores(spark, sf)))


@query("confusion_matrix", over("scores", f"""
select l as label, p as predicted, (select count(*) from scores where label = l and (score >= {THRESHOLD})::int = p) as n
from (select unnest([0, 1]) as l), (select unnest([0, 1]) as p)"""))
def confusion_matrix(spark, sf):
    return ops.confusion_matrix(views.scores(spark, sf), THRESHOLD)


def counts(threshold: str, source: str = "scores") -> str:
    return (f"select count(*) filter (label = 1 and score >= {threshold}) as tp,"
            f" count(*) filter (label = 0 and score >= {threshold}) as fp,"
            f" count(*) filter (label = 1 and score < {threshold}) as fn,"
            f" count(*) filter (label = 0 and score < {threshold}) as tn from {source}")


@query("classification_metrics", over("scores", """
select tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) as accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1, round(coalesce(fp / nullif(fp + tn, 0), 0), 6) as fpr,
  round(coalesce(tn / nullif(tn + fn, 0), 0), 6) as precision_0, round(coalesce(tn / nullif(tn + fp, 0), 0), 6) as recall_0,
  round(coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0), 6) as f1_0 from c""", c=counts(str(THRESHOLD))))
def classification_metrics(spark, sf):
    return rounded(ops.metrics(views.scores(spark, sf), THRESHOLD))


F1 = "select threshold, 2 * precision * recall / (precision + recall + 1e-8) as f1 from pr order by f1 desc, threshold limit 1"


@query("threshold_f1", with_cum("select round(threshold, 6) as threshold, round(f1, 6) as f1 from best", pr=PR, best=F1))
def threshold_f1(spark, sf):
    return rounded(ops.f1_threshold(views.scores(spark, sf)))


def recall_sql(floor: float) -> str:
    good = f"(select %s from pr where precision >= {floor} order by recall desc, threshold limit 1)"
    near = "(select %s from pr order by abs(threshold - 0.5), threshold limit 1)"
    return (f"select cast({floor} as double) as min_precision,"
            f" round(coalesce({good % 'threshold'}, 0.5), 6)::double as threshold,"
            f" round(coalesce({good % 'recall'}, {near % 'recall'}), 6) as recall,"
            f" round(coalesce({good % 'precision'}, {near % 'precision'}), 6) as precision")


@query("threshold_recall", with_cum(" union all ".join(recall_sql(f) for f in (0.75, 0.2, 1.01)), pr=PR))
def threshold_recall(spark, sf):
    scored, parts = views.scores(spark, sf), None
    for floor in (0.75, 0.2, 1.01):
        part = rounded(ops.recall_threshold(scored, floor)).withColumn("min_precision", F.lit(floor))
        parts = part if parts is None else parts.unionByName(part)
    return parts


def compared(name: str, threshold: str) -> str:
    return f"""
select '{name}' as name, round({threshold}, 6)::double as threshold, round(tp / nullif(tp + fn, 0), 6) as recall,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1, round(fp / nullif(fp + tn, 0), 6) as fpr
from ({counts(threshold)})"""


@query("threshold_compare", with_cum(
    compared("default", "0.5") + " union all " + compared("optimal", "(select threshold from best)"), pr=PR, best=F1))
def threshold_compare(spark, sf):
    return rounded(ops.threshold_compare(views.scores(spark, sf)))


@query("overfit_check", over("scores", """
select round(a.f1, 6) as train_f1, round(a.acc, 6) as train_accuracy, round(b.f1, 6) as test_f1,
  round(b.acc, 6) as test_accuracy, round(a.f1 - b.f1, 6) as f1_gap, round(abs(a.acc - b.acc), 6) as accuracy_gap,
  a.f1 - b.f1 > 0.1 as is_overfitting,
  case when a.f1 < 0.5 and b.f1 < 0.5 then 'underfit' when a.f1 - b.f1 > 0.1 then 'overfit' else 'normal' end as status,
  abs(a.acc - b.acc) > 0.05 as accuracy_overfit from m a, m b where a.is_baseline and not b.is_baseline""",
                            m="""select is_baseline, 2 * tp / (2 * tp + fp + fn) as f1, (tp + tn) / (tp + fp + fn + tn) as acc
from (select is_baseline, count(*) filter (label = 1 and score >= 0.1) as tp,
  count(*) filter (label = 0 and score >= 0.1) as fp, count(*) filter (label = 1 and score < 0.1) as fn,
  count(*) filter (label = 0 and score < 0.1) as tn from scores group by 1)"""))
def overfit_check(spark, sf):
    scored = views.scores(spark, sf).withColumn("split", F.when(F.col("is_baseline"), "train").otherwise("test"))
    return rounded(ops.overfit_check(scored, "split", THRESHOLD))


@query("class_weights", over("scores", """
select label, n, round(sum(n) over () / (count(*) over () * n), 6) as balanced_weight,
  round(sum(case when label = 0 then n end) over () / sum(case when label = 1 then n end) over (), 6) as neg_per_pos
from (select label, count(*) as n from scores group by 1)"""))
def class_weights(spark, sf):
    return rounded(ops.class_weights(views.scores(spark, sf)))


@query("proba_tier", over("scores", """
select event_id, (score >= 0.5)::int as predicted_label,
  case when score >= 0.7 then 'HIGH' when score >= 0.4 then 'MEDIUM' when score >= 0.15 then 'LOW' else 'SAFE' end
    as risk_level,
  case when score >= 0.7 then '🔴 Immediate block recommended. Add to Redis blacklist.'
       when score >= 0.4 then '🟡 Flag for human review. Monitor call patterns.'
       when score >= 0.15 then '🟠 Display warning label to user.' else '🟢 No action needed.' end as advice
from scores"""))
def proba_tier(spark, sf):
    level = scoring.probability_tier(F.col("score"))
    return views.scores(spark, sf).select(
        "event_id", ops.predicted(0.5).alias("predicted_label"), level.alias("risk_level"),
        scoring.tier_advice(level).alias("advice"))


POSITION = """
select *, row_number() over (partition by label order by md5(cast(event_id as varchar) || '|42'), event_id) as rn,
  count(*) over (partition by label) as m from scores"""


@query("stratified_split", over("scores", """
select event_id, label, case when rn <= round(m * 0.6) then 'train' when rn <= round(m * 0.8) then 'val' else 'test' end
  as split from p""", p=POSITION))
def stratified_split(spark, sf):
    rows = views.scores(spark, sf).select("event_id", "label")
    return sampling.stratified_split(rows, "label", "event_id", [("train", 0.6), ("val", 0.2), ("test", 0.2)])


@query("stratified_folds", over("scores", "select event_id, label, cast((rn - 1) % 5 as int) as fold from p", p=POSITION))
def stratified_folds(spark, sf):
    return sampling.stratified_folds(views.scores(spark, sf).select("event_id", "label"), "label", "event_id")
