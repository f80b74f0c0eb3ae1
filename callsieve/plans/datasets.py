"""Queries on training sets and label noise."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dataset as ops
from ..operators.complaints import FEATURES
from ..sources import views
from .complaints import FEATURES_SQL, GOOD_FEATURES_SQL, features, good_features, rounded
from .evaluation import rounded as all_rounded
from .oracle_views import over
from .registry import query

RANK = "row_number() over (order by md5(caller_id || '|42'), caller_id)"
ROUNDED = ", ".join(f"round({n}, 6) as {n}" for n in FEATURES)


def drawn(pool: str, n: str, origin: str) -> str:
    return f"""
select p.* exclude (rank), cast(unnest(range(cast(floor(({n} - rank) / (select count(*) from {pool})) as bigint) + 1)) as int)
  as copy, 0 as label, '{origin}' as origin
from (select *, {RANK} as rank from {pool}) p where rank <= {n}"""


@query("training_set", over("complaints known_good_complaints", f"""
select caller_id, copy, label, origin, caller_id || '#' || origin || '#' || cast(copy as varchar) as row_id, {ROUNDED}
from (select *, 0 as copy, 1 as label, 'positive' as origin from f where complaint_count_log > 1
  union all by name select * from hard union all by name select * from soft)""",
    f=FEATURES_SQL, g=GOOD_FEATURES_SQL, once="select * from f where complaint_count_log < 1",
    sizes="select count(*) as neg, cast(round_even(count(*) * 0.03, 0) as bigint) as hard_n from f where complaint_count_log > 1",
    hard=drawn("once", "(select hard_n from sizes)", "hard"),
    soft=drawn("g", "(select neg - hard_n from sizes)", "soft")))
def training_set(spark, sf):
    return rounded(ops.training_set(features(spark, sf), good_features(spark, sf)))


def judged(spark, sf):
    return ops.label_quality_flags(ops.given_label_quality(views.scores(spark, sf).select("event_id", "score", "label")))


QUALITY = "select event_id, label, case when label = 1 then score else 1 - score end as quality from scores"
FLAGGED = "select *, quality < (select quantile_cont(quality, 0.05) from q) as noisy from q"


@query("label_noise_flag", over("scores", "select event_id, label, round(quality, 6) as quality, noisy from n", q=QUALITY, n=FLAGGED))
def label_noise_flag(spark, sf):
    return all_rounded(judged(spark, sf).drop("score"))


@query("label_noise_remove", over("scores", "select event_id, label from n where not noisy", q=QUALITY, n=FLAGGED))
def label_noise_remove(spark, sf):
    return ops.remove_noisy(views.scores(spark, sf).select("event_id", "label"), judged(spark, sf), "event_id")


@query("label_noise_flip", over("scores", """
select event_id, case when noisy then 1 - label else label end as label from n""", q=QUALITY, n=FLAGGED))
def label_noise_flip(spark, sf):
    return ops.flip_noisy(judged(spark, sf)).select("event_id", "label")


@query("feature_shuffle", over("scores", """
select a.event_id, a.label, round(b.score, 6) as score
from (select *, row_number() over (order by md5(cast(event_id as varchar) || '|42'), event_id) as rn from scores) a
join (select *, row_number() over (order by md5(cast(event_id as varchar) || '|43'), event_id) as rn from scores) b
  on a.rn = b.rn"""))
def feature_shuffle(spark, sf):
    rows = views.scores(spark, sf).select("event_id", "label", "score")
    return all_rounded(ops.shuffle_feature(rows, "event_id", "score"))
