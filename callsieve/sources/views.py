"""Domain tables derived from the given parquet tables.

The engine's operators take call, complaint, report, fraud and score tables. These functions shape the
generic ``events``, ``customer`` and ``orders`` tables into them, so that work grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "cast(ts as timestamp) as ts", "user_id", "event_type", "value",
        # A pattern is cheaper than a JSON parse here: filters on derived columns repeat it before the scan.
        "try_cast(regexp_extract(props, '\"k\": ?([0-9]+)', 1) as bigint) as k")


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        "event_id as call_id",
        "case when k < 60 then concat('center-', k % 3) else concat('user-', user_id) end as phone_number",
        "user_id", "ts", "cast(floor(value) as bigint) as call_duration_sec",
        "element_at(array('TW','US','UK','JP','SG','AU','HK','DE'), cast(event_id % 8 as int) + 1) as caller_country",
        "element_at(array('TW','TW','TW','HK','MM'), cast(k % 5 as int) + 1) as callee_country",
        "case when k < 60 then event_type <> 'view' else event_type = 'error' end as is_voip",
        "case when k < 60 then event_type <> 'click' else event_type = 'error' and k % 2 = 0 end as reported_as_scam",
        "round(0.1 + (k % 30) / 10.0D, 2) as weight",
        "case when event_id % 50 = 0 then concat('user-', (user_id + 1) % 100) else concat('callee-', event_id % 97) end"
        " as callee_number",
        "concat('dev-', event_id % 5) as device_fp",
        "case when k % 10 = 9 then substr(md5(cast(event_id as string)), 1, 8) else '' end as sms_content_hash",
        "element_at(array('investment','customs','romance','impersonation'), cast(k % 4 as int) + 1) as scam_category",
        "event_id % 40 as reporter")


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        "event_id as ticket_id",
        "case when event_id % 97 = 0 then null when event_id % 89 = 0 then '555-555-5555'"
        " when k < 60 then concat('800-555-000', k % 3)"
        " else concat(200 + user_id % 700, '-555-', lpad(cast((user_id * 20 + k % 20) % 10000 as string), 4, '0')) end"
        " as caller_id",
        "case when event_id % 17 = 0 then 'not_a_date' when event_id % 101 = 0 then '01/01/1900'"
        " else date_format(ts - interval 7 year, 'MM/dd/yyyy') end as date_of_issue",
        "case when event_id % 19 = 0 then 'noon-ish' when event_id % 23 = 0 then '25:00 pm'"
        " else date_format(ts, 'h:mm a') end as time_of_issue",
        "case event_type when 'click' then 'Robocalls' when 'view' then"
        " 'Telemarketing (including do not call and spoofing)' when 'signup' then 'Indecency' when 'error' then"
        " 'Cramming (unauthorized charges on your phone bill)' end as issue",
        "case when k % 4 = 0 then 'Prerecorded Voice' when k % 4 = 1 then 'Abandoned Calls'"
        " when k % 4 = 2 then 'Live Voice' end as call_type",
        "case when k % 5 = 0 then 'Internet (VOIP)' when k % 5 = 1 then 'Wireless (cell phone/other mobile device)'"
        " when k % 5 = 2 then 'Wired' when k % 5 = 3 then 'VOIP Robocall' end as method",
        "concat('S', event_id % 50) as state", "lpad(cast(event_id * 37 % 100000 as string), 5, '0') as zip",
        "case when k % 3 = 0 then null when k % 3 = 1 then '800-555-0001' else '900-555-0000' end as advertiser")


def known_good_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaint-shaped contacts of ordinary numbers, one number per ordering customer."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as ticket_id",
        "concat('3', lpad(cast(o_custkey % 100 as string), 2, '0'), '-444-', o_custkey) as caller_id",
        "concat(lpad(cast(1 + o_orderkey % 12 as string), 2, '0'), '/',"
        " lpad(cast(1 + o_orderkey % 28 as string), 2, '0'), '/2016') as date_of_issue",
        "concat(8 + o_orderkey % 10, ':30') as time_of_issue",
        "case when o_orderkey % 11 = 0 then 'Robocalls' when o_orderkey % 7 = 0 then 'Telemarketing' end as issue",
        "case when o_orderkey % 3 = 0 then 'Live Voice' end as call_type",
        "case when o_orderkey % 2 = 0 then 'Wired' else 'Wireless' end as method",
        "concat('S', o_custkey % 4) as state",
        "cast(null as string) as advertiser")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter("event_type in ('click', 'view')").selectExpr(
        "event_id as report_seq", "user_id % 40 as user_id", "concat('num-', (user_id % 40) % 9) as phone_number",
        "element_at(array('investment','customs','romance','impersonation'), cast(k % 4 as int) + 1) as scam_category",
        "unix_micros(ts) / 1000000 / 100 as t",
        "case when user_id % 5 = 0 and event_id % 8 = 7 then 'RU' when event_id % 8 = 6 then 'SG' else 'TW' end"
        " as report_country", "'TW' as registered_country")


def validations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter("event_type in ('purchase', 'error')").selectExpr(
        "event_id as seq", "user_id % 40 as user_id", "unix_micros(ts) / 1000000 / 100 as t",
        "event_type = 'purchase' or user_id % 3 = 0 as was_correct")


def reporters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered reporters: three quarters of the ids that customers would report under."""
    return (table(spark, sf_dir, "customer").selectExpr("c_custkey % 40 as user_id")
            .filter("user_id % 4 <> 3").distinct().selectExpr("user_id", "'TW' as registered_country"))


def weighted_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter("event_type = 'click' or user_id % 4 = 0 and event_type = 'view'").selectExpr(
        "event_id as report_seq", "concat('num-', user_id) as phone_number",
        "element_at(array('investment','customs','romance','impersonation'), cast(k % 4 as int) + 1) as scam_category",
        "case when user_id % 4 = 0 then 1.0D when k % 10 < user_id % 10 then 0.65D when k % 3 = 0 then 0.35D"
        " else 0.1D end as user_weight")


def fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = table(spark, sf_dir, "orders").groupBy("o_custkey").agg({"o_totalprice": "sum", "*": "count"}).selectExpr(
        "o_custkey", "`count(1)` as n", "round(`sum(o_totalprice)`, 2) as loss")
    customer = table(spark, sf_dir, "customer")
    return customer.join(totals, customer.c_custkey == totals.o_custkey, "left").selectExpr(
        "cast(c_custkey as string) as Phone_Number",
        "case when c_custkey % 31 = 0 then 'bad' else cast(n as string) end as Report_Count",
        "case when c_custkey % 37 = 0 then null when c_custkey % 41 = 0 then '-5' else cast(loss as string) end"
        " as Financial_Loss",
        "case when c_custkey % 29 = 0 then null else c_mktsegment end as Age_Group",
        "concat('E', c_nationkey % 4) as Education",
        "case when c_custkey % 50 = 0 then 'C_POISON_BOT' when c_custkey % 11 = 0 then null else 'C_NORMAL' end"
        " as Cluster_ID",
        "case when c_custkey % 43 = 0 then '2' when c_acctbal < 0 then '1' else '0' end as Label")


def legacy_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        "event_id as Incident_ID", "cast(ts as string) as Report_Time", "concat('p-', user_id) as Phone_Number",
        "case when event_id % 29 = 0 then '機器人測試,auto' when event_id % 13 = 0 then null else event_type end as Tags",
        "cast(k * 60 as string) as Report_Count", "cast(round(value, 2) as string) as Transaction_Amount",
        "case when k % 4 = 0 then 'senior' when k % 4 = 1 then 'adult' else 'student' end as Victim_Demographic",
        "case when event_type = 'error' then '1' else '0' end as Is_Fraud")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        "event_id", "ts", "user_id", "ts < timestamp '2024-01-16' as is_baseline",
        "least(value / 300.0D, 1.0D) as score", "case when event_type = 'error' then 1 else 0 end as label")


def arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('exp-', 1 + o_custkey % 3 % 2) as experiment",
        "case when o_custkey % 2 = 0 then 'control' else 'treatment' end as arm",
        "case when o_orderstatus = 'F' then 1 else 0 end as hit",
        "case when o_orderpriority = '1-URGENT' then 1 else 0 end as false_alarm",
        "(o_orderkey % 100) / 100.0D as reporter_score")
