"""Queries that write their input as files and read it back: scans, sinks, layouts, model folders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, ml
from ..operators.complaints import FEATURES
from ..session import cut_lineage, scratch
from ..sources import files, views
from .complaints import features
from .oracle_views import over
from .registry import query

FIELDS = ["ticket_id", "caller_id", "issue", "state", "zip"]


@query("scan_csv_skip_bad", over("complaints", """
select cast(ticket_id as varchar) as ticket_id, caller_id, issue, case when ticket_id % 37 <> 0 then state end as state,
  case when ticket_id % 37 <> 0 then zip end as zip from complaints where ticket_id % 31 <> 0"""))
def scan_csv_skip_bad(spark, sf):
    """Every 31st line has a field too many and is skipped, every 37th other lacks two, which are null."""
    quoted = [F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"')) for c in FIELDS]
    fields = F.array(*[F.coalesce(q, F.lit("")) for q in quoted])
    line = (F.when(F.col("ticket_id") % 31 == 0, F.concat_ws(",", fields, F.lit("stray")))
            .when(F.col("ticket_id") % 37 == 0, F.concat_ws(",", F.slice(fields, 1, 3))).otherwise(F.concat_ws(",", fields)))
    path = scratch(spark, "csv")
    views.complaints(spark, sf).select(F.concat(line).alias("value")).write.option("header", False).text(path)
    # The scan takes the first line of each file as its header, as the files of the complaint table have one.
    headed = scratch(spark, "csv-headed")
    lines = spark.read.text(path)
    lines.mapInArrow(_headed(",".join(FIELDS)), "value string").write.text(headed)
    return files.scan_csv(spark, headed, FIELDS)


def _headed(header: str):
    """Put a header before the first line of each partition, which becomes one file."""

    def add(batches):
        import pyarrow as pa

        first = True
        for batch in batches:
            if first:
                yield pa.RecordBatch.from_arrays([pa.array([header])], names=["value"])
                first = False
            yield batch

    return add


@query("scan_csv_typed", over("fraud", """
select Phone_Number, try_cast(Report_Count as double) as Report_Count, try_cast(Financial_Loss as double) as Financial_Loss, Age_Group,
  try_cast(Label as integer) as Label from fraud"""))
def scan_csv_typed(spark, sf):
    path = scratch(spark, "csv")
    files.write_csv(views.fraud(spark, sf), path)
    types = {"Report_Count": "double", "Financial_Loss": "double", "Label": "int", "Absent": "int"}
    return files.scan_csv_typed(spark, path, types).select("Phone_Number", "Report_Count", "Financial_Loss", "Age_Group", "Label")


@query("sink_csv", over("complaints", "select cast(ticket_id as varchar) as ticket_id, caller_id, method, state, advertiser from complaints"))
def sink_csv(spark, sf):
    path = scratch(spark, "csv")
    files.write_csv(views.complaints(spark, sf).select("ticket_id", "caller_id", "method", "state", "advertiser"), path)
    return spark.read.option("header", True).csv(path)


@query("sink_json", over("calls", """
select phone_number, count(*) as calls, count(*) filter (is_voip) as voip_calls, round(sum(weight), 4) as weight,
  list_sort(list(distinct caller_country)) [1] as first_country from calls group by 1"""))
def sink_json(spark, sf):
    path = scratch(spark, "json")
    report = views.calls(spark, sf).groupBy("phone_number").agg(
        F.count("*").alias("calls"), F.count_if("is_voip").alias("voip_calls"), F.round(F.sum("weight"), 4).alias("weight"),
        F.array_sort(F.collect_set("caller_country")).alias("countries"))
    files.write_json(report, path)
    held = spark.read.schema("phone_number string, calls long, voip_calls long, weight double, countries array<string>").json(path)
    return held.select("phone_number", "calls", "voip_calls", "weight", F.col("countries")[0].alias("first_country"))


@query("schema_route", over("complaints", """
select 'complaints' as layout, (select count(*) from complaints where caller_id is not null and caller_id not in
  ('000-000-0000', '555-555-5555', '111-111-1111', '999-999-9999')) as n_rows
union all select 'legacy', null union all select 'production', null"""))
def schema_route(spark, sf):
    """Which layout each table is taken for; the complaint table also goes through its preparation."""
    tables = {"complaints": views.complaints(spark, sf), "production": views.fraud(spark, sf), "legacy": views.legacy_fraud(spark, sf)}
    cleaned = clean.route(tables["complaints"]).agg(F.count("*").alias("n"))
    layouts = spark.createDataFrame([(clean.detect_schema(t), name) for name, t in tables.items()], "layout string, given string")
    return layouts.select("layout", F.when(F.col("given") == "complaints", cleaned.scalar()).alias("n_rows"))


@query("model_roundtrip", over("complaints", """
select distinct caller_id, true as same_score, 0.5::double as threshold, 20 as n_features from complaints
where caller_id is not null and caller_id not in ('000-000-0000', '555-555-5555', '111-111-1111', '999-999-9999')"""))
def model_roundtrip(spark, sf):
    """Scores of a fitted model, and of the same model after it was saved with its threshold and feature names, scaler included."""
    rows = cut_lineage(features(spark, sf).withColumn("label", (F.col("is_voip") > 0).cast("int")).withColumnRenamed("caller_id", "row_id"))
    model, path = ml.fit_lr(rows, FEATURES, iterations=5), scratch(spark, "model")
    files.save_model(model, path, 0.5, FEATURES)
    loaded, threshold, names = files.load_model(spark, path)
    both = ml.score(model, rows).select("row_id", "score").join(
        ml.score(loaded, rows.select("row_id", *names)).select("row_id", F.col("score").alias("again")), "row_id")
    return both.select(F.col("row_id").alias("caller_id"), (F.col("score") == F.col("again")).alias("same_score"),
                       F.lit(threshold).alias("threshold"), F.lit(len(names)).alias("n_features"))
