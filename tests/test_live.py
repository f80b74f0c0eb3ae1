"""Running stream features, the gate and write suppression in batch form."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from callsieve.operators import live
from callsieve.operators.complaints import FEATURES

GATED = "call_id long, phone_number string, s double, total_calls long, probability double"


def gated(spark, rows):
    return spark.createDataFrame(rows, GATED).select(
        "call_id", "phone_number", F.timestamp_seconds("s").alias("ts"), "total_calls", "probability")


def by_hand(values):
    last, kept = None, []
    for i, p in values:
        if last is None or abs(p - last) > 0.01:
            last = p
            kept.append(i)
    return kept


def test_write_suppression_compares_with_the_last_written(spark):
    rows = [(i, "a", i * 4000.0, 9, p) for i, p in enumerate([0.90, 0.905, 0.912, 0.925])]
    got = live.write_dedup(gated(spark, rows)).collect()
    assert sorted(r["probability"] for r in got) == [0.90, 0.912, 0.925]


@pytest.mark.parametrize("digits", [4, 17])
@pytest.mark.parametrize("apart", [40, 400])
def test_write_suppression_equals_the_fold(spark, digits, apart):
    random.seed(11)
    rows, want, i = [], [], 0
    for phone, n in (("hot", 900), ("b", 100), ("c", 1)):
        p, series = 0.7, []
        for j in range(n):
            p = round(min(0.99, max(0.5, p + random.choice((-0.004, 0.0, 0.003, 0.01)) * (1 if digits == 4 else random.random()))), digits)
            rows.append((i, phone, float(j * apart), 9, p))
            series.append((i, p))
            i += 1
        want += by_hand(series)
    got = live.write_dedup(gated(spark, rows).repartition(4))
    assert sorted(r["call_id"] for r in got.collect()) == want


def test_write_suppression_with_odd_rows(spark):
    rows = [(1, "a", None, 9, 0.9), (2, "a", 5.0, 9, None), (3, "a", 6.0, 9, 0.9), (4, None, 7.0, 9, 0.8), (5, None, 8.0, 9, 0.7), (6, "a", 9.0, 9, 0.5)]
    assert sorted(r["call_id"] for r in live.write_dedup(gated(spark, rows)).collect()) == [1, 4, 5, 6]
    assert live.write_dedup(gated(spark, rows).limit(0)).collect() == []


def calls(spark, rows):
    return spark.createDataFrame(rows, "call_id long, phone_number string, s double, caller_country string, is_voip boolean,"
                                       " call_duration_sec long").withColumn("ts", F.timestamp_seconds("s"))


def test_running_stream_features(spark):
    # Monday 2026-08-03 at 23, 3 and 10 o'clock of the following days.
    monday = 1785715200
    rows = [(1, "a", monday + 23 * 3600.0, "MM", True, 3), (2, "a", monday + 27 * 3600.0, "MM", True, 100),
            (3, "a", monday + 34 * 3600.0, "KH", True, 5), (4, "a", monday + 34 * 3600.0, "TH", False, 5)]
    got = {r["call_id"]: r for r in live.running_features(calls(spark, rows)).collect()}
    assert got[3]["night_ratio"] == pytest.approx(2 / 3) and got[4]["is_voip"] == 0.75
    assert [got[i]["unique_states_norm"] for i in (1, 2, 3, 4)] == pytest.approx([0.1, 0.1, 0.2, 0.3])
    assert got[4]["prerecorded_ratio"] == got[4]["abandoned_call_ratio"] == 0.75 and got[4]["live_voice_ratio"] == 0.25
    assert [got[4][n] for n in ("robocall_flag", "complaint_count_log", "complaint_velocity")] == [0.0, 0.0, 0.0]
    assert [c for c in live.running_features(calls(spark, rows)).columns if c in FEATURES] == FEATURES


def test_gate_needs_five_calls(spark):
    df = spark.createDataFrame([("a", 4, 1.0), ("a", 5, 0.49), ("b", 5, 0.5)], "phone_number string, total_calls long, probability double")
    assert [r["phone_number"] for r in live.gate(df, 0.5).collect()] == ["b"]
