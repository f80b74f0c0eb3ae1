"""Queries that profile tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean
from ..operators import profile as ops
from ..sources import views
from .cleaning import CHAIN, TYPED
from .oracle_views import VIEWS, over
from .registry import query

RAW_COLUMNS = ["Phone_Number", "Report_Count", "Financial_Loss", "Age_Group", "Education", "Cluster_ID", "Label"]
#: What the automatic choice of numeric columns takes from the tables.
LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EVENT_NUMBERS = ["event_id", "user_id", "value", "k"]


def each(parts: list[str]) -> str:
    return " union all ".join(parts)


@query("profile_missing", over("fraud", each([f"""
select '{c}' as "column", count(*) filter ({c} is null) as missing,
  round(count(*) filter ({c} is null) / count(*) * 100, 2) as missing_pct,
  round(count(*) filter ({c} is null) / count(*) * 100, 2) < 20 as pass from fraud""" for c in RAW_COLUMNS])))
def profile_missing(spark, sf):
    return ops.missing(views.fraud(spark, sf))


@query("profile_duplicates", """
select (select count(*) from lineitem) as rows, (select count(*) from lineitem) - count(*) as duplicates,
  round(((select count(*) from lineitem) - count(*)) / (select count(*) from lineitem) * 100, 2) as duplicate_pct
from (select distinct * from lineitem)""")
def profile_duplicates(spark, sf):
    return ops.duplicates(views.table(spark, sf, "lineitem"))


@query("profile_outliers_iqr", over("", each([f"""
select '{c}' as "column", count({c}) as "values", count(*) filter (out) as outliers,
  round(count(*) filter (out) / count({c}) * 100, 2) as outlier_pct, count(*) filter (out) / count({c}) > 0.05 as flagged
from (select {c}, {c} < q1 - 1.5 * (q3 - q1) or {c} > q3 + 1.5 * (q3 - q1) as out from ev,
  (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from ev))"""
    for c in EVENT_NUMBERS]), ev=VIEWS["ev"]))
def profile_outliers_iqr(spark, sf):
    return ops.iqr_outliers(views.events(spark, sf))


@query("profile_outliers_z", over("", each([f"""
select '{c}' as "column", count(*) filter (abs(({c} - m) / s) > 3) as extremes
from ev, (select avg({c}) as m, stddev_pop({c}) as s from ev)""" for c in EVENT_NUMBERS]), ev=VIEWS["ev"]))
def profile_outliers_z(spark, sf):
    return ops.z_extremes(views.events(spark, sf))


@query("profile_describe", each([f"""
select '{c}' as "column", count({c}) as count, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std,
  round(min({c})::double, 4) as min, round(quantile_cont({c}::double, 0.25), 4) as q25, round(median({c}::double), 4) as q50,
  round(quantile_cont({c}::double, 0.75), 4) as q75, round(max({c})::double, 4) as max from lineitem""" for c in LINE]))
def profile_describe(spark, sf):
    table = ops.describe(views.table(spark, sf, "lineitem"))
    return table.withColumns({c: F.round(c, 4) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")})


@query("profile_categorical", over("fraud", each([f"""
select '{c}' as "column", count(distinct {c}) as n_unique,
  case when count(distinct {c}) < 10 then 'One-Hot' else 'Target Encoding' end as encoding_hint from fraud"""
    for c in ("Age_Group", "Education", "Cluster_ID", "Phone_Number")])))
def profile_categorical(spark, sf):
    return ops.categorical(views.fraud(spark, sf), ["Age_Group", "Education", "Cluster_ID", "Phone_Number"])


@query("profile_types", each([f"""
select count(*) as rows, '{c}' as "column", '{t}' as type, '{k}' as kind from events""" for c, t, k in (
    ("event_id", "bigint", "numeric"), ("ts", "timestamp", "other"), ("user_id", "bigint", "numeric"),
    ("event_type", "string", "categorical"), ("value", "double", "numeric"), ("k", "bigint", "numeric"))]))
def profile_types(spark, sf):
    return ops.column_types(views.events(spark, sf))


@query("profile_checklist", over("scores", """
select 'missing below 20%' as "check", count(*) filter (score is null) / count(*) < 0.2 and count(*) filter (label is null)
  / count(*) < 0.2 as passed from scores
union all select unnest(['outliers identified', 'categorical columns reviewed', 'numeric columns reviewed',
  'target distribution known']), true"""))
def profile_checklist(spark, sf):
    return ops.checklist(views.scores(spark, sf), "label")


@query("class_balance", over("scores", """
select label, n, round(n / sum(n) over () * 100, 2) as pct, round(max(n) over () / min(n) over (), 1) as imbalance_ratio
from (select label, count(*) as n from scores group by 1)"""))
def class_balance(spark, sf):
    return ops.class_balance(views.scores(spark, sf), "label")


@query("histogram_by_class", over("scores", """
select s.label, cast(s.bin as int) as bin, round(lo + s.bin * w, 6) as bin_start, coalesce(n, 0) as n,
  round(coalesce(n / (total * w), 0), 6) as density
from (select label, lo, w, total, unnest(range(50)) as bin from f) s
left join (select label, least(floor((score - lo) / w), 49) as bin, count(*) as n from scores join f using (label)
           group by 1, 2) c on s.label = c.label and s.bin = c.bin""",
    f="select label, min(score) as lo, (max(score) - min(score)) / 50 as w, count(*) as total from scores group by 1"))
def histogram_by_class(spark, sf):
    table = ops.histogram(views.scores(spark, sf), "score", "label")
    return table.withColumn("bin_start", F.round("bin_start", 6)).withColumn("density", F.round("density", 6))


@query("correlation_pairs", each([f"""
select '{a}' as column_a, '{b}' as column_b, round(corr({a}, {b}), 6) as r, abs(corr({a}, {b})) > 0.9 as strong
from lineitem""" for i, a in enumerate(LINE) for b in LINE[i + 1:]]))
def correlation_pairs(spark, sf):
    return ops.correlation_pairs(views.table(spark, sf, "lineitem")).withColumn("r", F.round("r", 6))


@query("box_stats", over("scores", each([f"""
select label, '{c}' as "column", count({c}) as n, round(min({c})::double, 6) as min, round(quantile_cont({c}::double, 0.25), 6) as q1,
  round(median({c}::double), 6) as median, round(quantile_cont({c}::double, 0.75), 6) as q3, round(max({c})::double, 6) as max
from scores group by label""" for c in ("event_id", "user_id", "score")])))
def box_stats(spark, sf):
    table = ops.box_stats(views.scores(spark, sf), None, "label", [0, 1])
    return table.withColumns({c: F.round(c, 6) for c in ("min", "q1", "median", "q3", "max")})


def metric(section: str, name: str, expr: str, source: str, column: str = "") -> str:
    return (f"select '{section}' as section, '{column}' as \"column\", '{name}' as metric, ({expr})::double as value"
            f" from {source}")


NUM = "try_cast({} as double)"
RAW_METRICS = [
    metric("raw", "rows", "count(*)", "fraud"), metric("raw", "columns", str(len(RAW_COLUMNS)), "(select 1)"),
    metric("raw", "invalid_label_rows", "count(*) filter (try_cast(Label as double) is null)", "fraud"),
    metric("raw", "label_0_rows", "count(*) filter (try_cast(Label as double) = 0)", "fraud"),
    metric("raw", "label_1_rows", "count(*) filter (try_cast(Label as double) = 1)", "fraud"),
    metric("raw", "negative_report_count_rows", "count(*) filter (try_cast(Report_Count as double) < 0)", "fraud"),
    metric("raw", "negative_financial_loss_rows", "count(*) filter (try_cast(Financial_Loss as double) < 0)", "fraud"),
] + [
    metric("raw", "missing_pct", f"round(count(*) filter ({c} is null) / count(*) * 100, 2)", "fraud", c) for c in RAW_COLUMNS
] + [
    f"select 'raw', '{c}', 'high_missing_pct', p from (select round(count(*) filter ({c} is null) / count(*) * 100, 2) as p"
    f" from fraud) where p >= 5" for c in RAW_COLUMNS
] + [
    metric("raw", "iqr_outliers", "count(*) filter (x < q1 - 1.5 * (q3 - q1) or x > q3 + 1.5 * (q3 - q1))",
           f"(select {NUM.format(c)} as x from fraud), (select quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.75) as q3"
           f" from (select {NUM.format(c)} as x from fraud))", c) for c in ("Report_Count", "Financial_Loss")
] + [
    metric("clean", "rows", "count(*)", "derived"), metric("clean", "class_0_rows", "count(*) filter (Label = 0)", "derived"),
    metric("clean", "class_1_rows", "count(*) filter (Label = 1)", "derived"), metric("clean", "missing_cells", "0", "(select 1)"),
    metric("clean", "any_missing", "0", "(select 1)"),
    metric("clean", "columns", "5 + count(distinct Age_Group) + count(distinct Education)", "derived"),
    metric("clean", "imbalance_0_to_1",
           "round(count(*) filter (Label = 0) / greatest(count(*) filter (Label = 1), 1), 4)", "derived"),
    metric("diff", "rows_dropped", "(select count(*) from fraud) - count(*)", "derived"),
    metric("diff", "rows_retained_pct", "round(count(*) / (select count(*) from fraud) * 100, 3)", "derived"),
]


@query("quality_raw_clean", over("fraud", each(RAW_METRICS), **CHAIN))
def quality_raw_clean(spark, sf):
    raw = views.fraud(spark, sf)
    return ops.raw_clean_report(raw, clean.prepare_fraud(raw))
