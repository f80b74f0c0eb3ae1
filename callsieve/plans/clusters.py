"""Queries on density clusters and neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, neighbors
from ..operators import cluster as ops
from ..session import cut_lineage
from ..sources import views
from .cleaning import AGES, CHAIN, EDUCATION, hot
from .cleaning import scaled as sql_scaled
from .evaluation import rounded
from .oracle_views import over
from .registry import query

EPS, MIN_POINTS = 0.6, 10
#: The whole prepared matrix: scaled figures, flag, and all levels of the categories.
MATRIX = [*clean.SCALED, "high_frequency_flag", *[f"Age_Group_{v}" for v in AGES], *[f"Education_{v}" for v in EDUCATION]]
DISTANCE = " + ".join(f"({{a}}.x{i} - {{b}}.x{i}) * ({{a}}.x{i} - {{b}}.x{i})" for i in range(len(MATRIX)))
PREPARED = f"""
select Phone_Number, Label, high_frequency_flag, {', '.join(sql_scaled(c, 'derived') for c in clean.SCALED)},
  {hot('Age_Group', AGES)}, {hot('Education', EDUCATION)} from derived"""
Z = "select cast(Phone_Number as bigint) as id, Label, " + ", ".join(f'"{c}"::double as x{i}' for i, c in enumerate(MATRIX)) + " from prepared"
X = [f"x{i}" for i in range(len(MATRIX))]


def matrix(spark, sf):
    table = clean.prepare_fraud(views.fraud(spark, sf))
    table = table.withColumns({c: F.round(c, 6) for c in clean.SCALED})
    held = [F.col(c).cast("double") if c in table.columns else F.lit(0.0) for c in MATRIX]
    return cut_lineage(table.select(F.col("Phone_Number").cast("long").alias("id"), F.col("Label").alias("label"), *[c.alias(x) for c, x in zip(held, X)]))


NEAR = f"select a.id as a, b.id as b from z a join z b on {DISTANCE.format(a='a', b='b')} <= {EPS} * {EPS}"


@query("dbscan_neighbors", over("fraud", f"""
select id, (select count(*) from near where near.a = z.id) >= {MIN_POINTS} as is_core from z""", **CHAIN, prepared=PREPARED, z=Z, near=NEAR))
def dbscan_neighbors(spark, sf):
    points = ops.points_in_cells(matrix(spark, sf), "id", X, EPS)
    return ops.core_points(points, len(X), EPS, MIN_POINTS).select("id", "is_core")


def labelled(spark, sf):
    rows = matrix(spark, sf)
    return rows.join(ops.dbscan(rows, "id", X, EPS, MIN_POINTS), "id")


CORE = f"select a as id from near group by a having count(*) >= {MIN_POINTS}"
LINKS = "select a, b from near where a in (select id from core) and b in (select id from core)"
#: Smallest core id reachable, one step of all links at a time.
SPREAD = """
select 0 as step, id, id as label from core
union all
select step + 1, links.a, min(label) from spread join links on links.b = spread.id where step < 150 group by step, links.a"""
LABELS = "select id, min(label) as label from spread group by id"
NAMED = "select id, cast(dense_rank() over (order by label) - 1 as integer) as cluster from labels"
CLUSTERS = """
select z.id, coalesce(named.cluster, min(o.cluster), -1) as cluster, named.id is not null as is_core
from z left join named on named.id = z.id left join near on near.a = z.id left join named o on o.id = near.b
group by z.id, named.id, named.cluster"""
DENSITY = {**CHAIN, "prepared": PREPARED, "z": Z, "near": NEAR, "core": CORE, "links": LINKS, "spread": SPREAD, "labels": LABELS,
           "named": NAMED, "clusters": CLUSTERS}


@query("dbscan", over("fraud", "select * from clusters", **DENSITY))
def dbscan(spark, sf):
    return ops.dbscan(matrix(spark, sf), "id", X, EPS, MIN_POINTS)


@query("silhouette", over("fraud", """
select (select count(*) from p) as points, (select count(distinct cluster) from p) as clusters,
  round(avg(case when own_rows = 1 or greatest(a, b) = 0 then 0 else (b - a) / greatest(a, b) end), 6) as silhouette
from (select id, any_value(m) as own_rows, max(total) filter (mine) / nullif(max(n) filter (mine) - 1, 0) as a, min(total / n) filter (not mine) as b
      from (select d.*, sizes.m from d join p using (id) join sizes on sizes.cluster = p.cluster) group by id)""", **DENSITY, p="""
select z.*, cluster from clusters join z using (id) where cluster <> -1 order by md5(cast(id as varchar) || '|42'), id limit 5000""",
                             sizes="select cluster, count(*) as m from p group by 1", d=f"""
select p.id, p.cluster = o.cluster as mine, count(*) as n, sum(sqrt({DISTANCE.format(a='p', b='o')})) as total
from p, p o group by p.id, p.cluster, o.cluster"""))
def silhouette(spark, sf):
    from ..operators.ml import silhouette as score

    return rounded(score(labelled(spark, sf), "id", X, "cluster"))


GIVEN = """
select vec_id, case when vec_id % 10 = 0 then -1 else label end as cluster, label % 4 as truth, (vec_id % 3 = 0 or label = 1)::int
  as label from embeddings"""


def given(spark, sf):
    """Cluster numbers, true groups and fraud labels of the embedding table."""
    return views.table(spark, sf, "embeddings").selectExpr(
        "vec_id", "case when vec_id % 10 = 0 then -1 else label end as cluster", "label % 4 as truth",
        "cast(vec_id % 3 = 0 or label = 1 as int) as label")


@query("cluster_sizes", over("", """
select cluster, case when cluster = -1 then 'noise' else 'cluster_' || cast(cluster as varchar) end as name, n,
  round(n / sum(n) over () * 100, 2) as pct, count(*) filter (cluster <> -1) over () as n_clusters
from (select cluster, count(*) as n from given group by 1)""", given=GIVEN))
def cluster_sizes(spark, sf):
    return ops.cluster_sizes(given(spark, sf))


@query("cluster_fraud_rates", over("", """
select cluster, count(*) as count, cast(sum(label) as bigint) as fraud_count, round(avg(label), 6) as fraud_rate,
  case when cluster = -1 then 'noise' else 'cluster_' || cast(cluster as varchar) end as cluster_name, avg(label) > 0.5 as flagged
from given group by 1""", given=GIVEN))
def cluster_fraud_rates(spark, sf):
    return rounded(ops.cluster_fraud_rates(given(spark, sf)))


@query("cluster_ari", over("", """
select round((i - a * b / t) / ((a + b) / 2 - a * b / t), 6) as ari from (select
  (select sum(n * (n - 1) / 2) from (select count(*) as n from given group by cluster, truth)) as i,
  (select sum(n * (n - 1) / 2) from (select count(*) as n from given group by cluster)) as a,
  (select sum(n * (n - 1) / 2) from (select count(*) as n from given group by truth)) as b,
  (select count(*) * (count(*) - 1) / 2 from given) as t)""", given=GIVEN))
def cluster_ari(spark, sf):
    return rounded(ops.adjusted_rand_index(given(spark, sf), "cluster", "truth"))


@query("embed_2d")
def embed_2d(spark, sf):
    from ..operators.ml import embed_2d as embed

    return embed(views.table(spark, sf, "embeddings"), "vec_id", "embedding", "label")


@query("smote")
def smote(spark, sf):
    rows = views.table(spark, sf, "embeddings").select("vec_id", "embedding", (F.col("label") == 1).cast("int").alias("label"))
    table = neighbors.smote(rows, "vec_id", "embedding", "label")
    return table.select("vec_id", "label", "synthetic", F.round(F.aggregate(
        "embedding", F.lit(0.0), lambda a, x: a + x), 6).alias("vector_sum"))
