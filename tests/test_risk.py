"""Salting, tiers, heuristic score and behaviour windows."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from callsieve.functions import scoring
from callsieve.operators import behavior, skew
from callsieve.sources import views


def calls(spark, counts):
    keys = [k for k, n in counts.items() for _ in range(n)]
    rows = [(i, k, i % 3 == 0, i % 2 == 0, i % 60, 0.5) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "call_id long, phone_number string, reported_as_scam boolean, is_voip boolean,"
                                       " call_duration_sec long, weight double")


def test_only_keys_at_the_threshold_are_salted(spark):
    partials = skew.salted_partial(calls(spark, {"a": 1000, "b": 999, "x_12": 5}))
    salted = {r["phone_number"] for r in partials.filter("salt is not null").collect()}
    assert salted == {"a"}
    assert partials.filter("phone_number = 'b'").count() == 1


def test_salted_totals_equal_plain_totals(spark):
    df = calls(spark, {"a": 1500, "b": 7, "x_12": 5})
    got = skew.number_risk(skew.merged(skew.salted_partial(df))).select("phone_number", "call_count", "scam_reports", "voip_count")
    want = df.groupBy("phone_number").agg(F.count("*"), F.count_if("reported_as_scam"), F.count_if("is_voip"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    fewer = skew.number_risk(skew.merged(skew.salted_partial(df, threshold=1, salts=4))).select(*got.columns)
    assert sorted(got.collect()) == sorted(fewer.collect())


def test_hot_rows_and_skew_alert(spark):
    df = calls(spark, {"a": 1000, **{f"k{i}": 1 for i in range(30)}})
    assert skew.hot_rows(df, "phone_number", "call_id").count() == 1000
    assert skew.skew_ratio(df, "phone_number").first()["skew_alert"]
    assert not skew.skew_ratio(calls(spark, {"a": 3, "b": 3}), "phone_number").first()["skew_alert"]


@pytest.mark.parametrize("rate, weight, voip, tier", [
    (0.7, 0, 0, "HIGH"), (0.69, 50.0, 0.81, "HIGH"), (0.2, 50.0, 0.8, "MEDIUM"), (0.1, 0.0, 0, "LOW"), (0.09, 19.9, 0, "SAFE"),
    (0.3, 0, 0, "MEDIUM")])
def test_risk_tiers(spark, rate, weight, voip, tier):
    got = spark.range(1).select(scoring.risk_tier(F.lit(float(rate)), F.lit(float(weight)), F.lit(float(voip)))).first()[0]
    assert got == tier


def heuristic(spark, voip, reports, duration, country):
    score = scoring.heuristic_score(F.lit(voip), F.lit(reports), F.lit(duration), F.lit(country))
    return tuple(spark.range(1).select(score, scoring.probability_tier(score)).first())


def test_heuristic_score(spark):
    score, level = heuristic(spark, True, 12, 45, "TW")
    assert score == pytest.approx(0.35 + 0.1 * math.log(13) + 0.05) and level == "MEDIUM"
    edges = [heuristic(spark, False, 0, d, "TW")[0] for d in (4, 5, 30, 31, 179, 180)]
    assert edges == pytest.approx([0.10, 0, 0, 0.05, 0.05, 0])


def test_salt_round_trip_and_natural_suffix(spark):
    row = spark.range(1).select(skew.strip_salt(skew.salted_key(F.lit("x"), F.lit(7))), skew.salted_key(F.lit("x"), F.lit(7)),
                                skew.salted_key(F.lit("x_12"), F.lit(None).cast("int"))).first()
    assert tuple(row) == ("x", "x_07", "x_12")


def test_busiest_window_ignores_slot_borders(spark):
    seconds = [3590, 3595, 3598, 3605, 3899, 3890, 10_000, 10_299, 10_300]
    df = spark.createDataFrame([("a", float(s)) for s in seconds], "phone_number string, s double").select(
        "phone_number", F.timestamp_seconds("s").alias("ts"))
    # 3595 to 3890 is the fullest window and crosses a slot border; 3590 and 3890 are 300 s apart, one too many.
    assert behavior.busiest_window(df).first()["burst_count_5min"] == 4


def test_behavior_features_without_reports(spark):
    table = views.calls(spark, "/root/testdata/sf0.001")
    row = behavior.behavior_features(table, table.limit(0)).first()
    assert [row[n] for n in behavior.ZERO_WITHOUT_REPORTS] == [0.0] * 5
