"""Reputation, burst limit and consensus rules."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from callsieve.functions import scoring
from callsieve.operators import burst
from callsieve.operators import reputation as ops
from callsieve.operators.prefix import ranged


def rating(spark, alpha, beta, total, strikes=0, geo=False):
    s = scoring.reputation(F.lit(float(alpha)), F.lit(float(beta)), F.lit(total), F.lit(strikes), F.lit(geo))
    return tuple(spark.range(1).select(s, scoring.reputation_tier(s), scoring.report_weight(s)).first())


def test_new_reporter(spark):
    score, tier, weight = rating(spark, 2, 2, 0)
    assert 0.25 <= score <= 0.35 and tier == "tier_1" and weight == 0.10


def test_experienced_reporter_and_penalties(spark):
    score, tier, weight = rating(spark, 47, 5, 50)
    assert score == pytest.approx(0.6996, abs=1e-4) and tier == "tier_3" and weight == 0.65
    assert rating(spark, 47, 5, 50, strikes=5)[0] == pytest.approx(score - 0.15)
    assert rating(spark, 47, 5, 50, geo=True)[0] == pytest.approx(score - 0.10)


def test_beta_updates(spark):
    df = spark.createDataFrame([(i, 1, float(i), True) for i in range(20)] + [(100 + i, 2, float(i), False) for i in range(10)],
                               "seq long, user_id long, t double, was_correct boolean")
    last = {r["user_id"]: r for r in ops.beta_running(df).filter("seq in (19, 109)").collect()}
    assert (last[1]["alpha"], last[1]["beta"]) == (22.0, 2.0)
    assert (last[2]["alpha"], last[2]["beta"]) == (2.0, 12.0)


def throttled_by_hand(times, gap=300.0, limit=10):
    count, last, out = 0, None, []
    for t in times:
        if last is None or t - last > gap:
            count = 0
        if count < limit:
            count, last = count + 1, t
            out.append((True, count))
        else:
            out.append((False, count))
    return out


def check_burst(spark, users):
    rows = [(u * 10_000 + i, u, t) for u, times in users.items() for i, t in enumerate(sorted(times))]
    df = spark.createDataFrame(rows, "report_seq long, user_id long, t double")
    got = {r["report_seq"]: (r["accepted"], r["burst_count"]) for r in burst.burst_throttle(df).collect()}
    for u, times in users.items():
        assert [got[u * 10_000 + i] for i in range(len(times))] == throttled_by_hand(sorted(times)), u


def test_burst_fixtures(spark):
    check_burst(spark, {
        1: [0.0] * 11 + [301.0],           # the eleventh is throttled, the one after 301 s starts a new count
        2: [0.0] * 10 + [300.0],           # exactly 300 s later is still throttled
        3: [20.0 * i for i in range(40)],  # 20 of 40 accepted
        4: [0.0], 5: [100.0 * i for i in range(30)], 6: [301.0 * i for i in range(30)]})


def test_burst_on_random_and_dense_sessions(spark):
    random.seed(3)
    users = {u: [random.choice((1, 5, 40, 290, 310)) * random.random() for _ in range(60)] for u in range(1, 6)}
    users = {u: [round(sum(steps[: i + 1]), 3) for i in range(len(steps))] for u, steps in users.items()}
    users[9] = [round(random.random() * 20_000, 2) for _ in range(3000)]  # one reporter with most reports
    check_burst(spark, users)


def test_burst_of_one_reporter_spreads_over_tasks(spark):
    """A million reports within 300 s: no range holds much more than its share, and the answer is that of the fold."""
    n, pieces = 1_000_000, 16
    seconds = (F.pmod(F.xxhash64("id"), F.lit(2_400)) / 8).cast("double")  # many reports at each moment
    df = spark.range(n).select(F.col("id").alias("report_seq"), F.lit(1).cast("long").alias("user_id"), seconds.alias("t"))
    load = ranged(df, ["user_id", "t", "report_seq"], "range", pieces).groupBy("range").agg(
        F.count("*").alias("n"), F.min(F.struct("t", "report_seq")).alias("first"), F.max(F.struct("t", "report_seq")).alias("last"))
    load = load.orderBy("range").collect()
    assert len(load) == pieces and max(r["n"] for r in load) < 2 * n / pieces
    assert all(a["last"] < b["first"] for a, b in zip(load, load[1:]))
    got = burst.burst_throttle(df, gap=7.0, ranges=pieces).filter("accepted").select("report_seq", "burst_count").collect()
    given = sorted((r["t"], r["report_seq"]) for r in df.collect())
    kept = throttled_by_hand([t for t, _ in given], gap=7.0)
    assert sorted(map(tuple, got)) == sorted((seq, count) for (_, seq), (accepted, count) in zip(given, kept) if accepted)


def test_sessions_merge_at_exactly_the_gap(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 300.0), (1, 600.5), (1, 901.0)], "user_id long, t double")
    got = sorted((r["session_start"], r["reports"]) for r in burst.report_sessions(df).collect())
    assert got == [(0.0, 2), (600.5, 1), (901.0, 1)]


REPORT = ("report_seq long, user_id long, phone_number string, scam_category string, t double, report_country string,"
          " registered_country string")


def decide(spark, reports, validations=()):
    reporters = spark.createDataFrame([(1, "TW"), (2, "RU"), (3, "TW"), (4, "TW")], "user_id long, registered_country string")
    told = spark.createDataFrame(list(validations), "seq long, user_id long, t double, was_correct boolean")
    table = ops.report_decisions(spark.createDataFrame(reports, REPORT), told, reporters)
    return {r["report_seq"]: r for r in table.collect()}


def test_submission_pipeline(spark):
    got = decide(spark, [(1, 99, "p", "a", 0.0, "TW", "TW"), (2, 1, "p", "a", 1.0, "RU", "TW"), (3, 2, "p", "b", 2.0, "TW", "RU"),
                         (4, 3, "q", "c", 3.0, "TW", "TW"), (5, 1, "p", "b", 400.0, "TW", "TW")])
    assert got[1]["status"] == "error"
    assert got[2]["geo_flag"] and not got[3]["geo_flag"] and got[5]["geo_flag"]  # once flagged, always flagged
    assert got[4]["burst_count"] == 1 and got[4]["reputation"] == pytest.approx(0.27)  # the first report already costs 0.03
    assert {r["decision"] for r in got.values() if r["decision"]} <= {"BLOCK", "REVIEW", "SUSPECT", "SAFE"}
    assert got[5]["number_reports"] == 3


def test_throttled_reports_change_nothing(spark):
    rows = [(i, 1, "p", "a", float(i), "RU" if i == 10 else "TW", "TW") for i in range(11)] + [(11, 1, "p", "a", 400.0, "TW", "TW")]
    got = decide(spark, rows)
    assert got[10]["status"] == "throttled"
    assert got[11]["burst_count"] == 1 and not got[11]["geo_flag"] and got[11]["number_reports"] == 11


def test_weight_follows_validations_before_the_report(spark):
    told = [(100 + i, 1, float(i), True) for i in range(40)]
    got = decide(spark, [(1, 1, "p", "a", 5.5, "TW", "TW"), (2, 1, "p", "a", 1000.0, "TW", "TW")], told)
    assert got[1]["user_weight"] <= got[2]["user_weight"] == 0.65


WEIGHTED = "report_seq long, phone_number string, scam_category string, user_weight double"


def test_consensus_minimum_and_candidates(spark):
    df = spark.createDataFrame([(1, "two", "a", 1.0), (2, "two", "a", 1.0), (3, "three", "a", 1.0), (4, "three", "a", 1.0),
                                (5, "three", "a", 1.0), (6, "one", "a", 0.65)], WEIGHTED)
    last = {r["phone_number"]: r["decision"] for r in ops.running_consensus(df).filter("report_seq in (2, 5, 6)").collect()}
    assert last == {"two": "REVIEW", "three": "BLOCK", "one": "REVIEW"}
    assert {r["phone_number"] for r in ops.blacklist_candidates(ops.phone_consensus(df)).collect()} == {"two", "three"}
    first = ops.running_consensus(df).filter("number_reports = 1").select("decision").collect()
    assert all(r[0] != "BLOCK" for r in first)


def test_dominant_category_tie_goes_to_the_first(spark):
    df = spark.createDataFrame([(1, "p", "a", 0.35), (2, "p", "b", 0.10), (3, "p", "b", 0.25), (4, "p", "b", 0.10)], WEIGHTED)
    assert ops.phone_consensus(df.filter("report_seq < 4")).first()["dominant_category"] == "a"
    for width in (1, 2, 100):
        got = ops.running_dominant_category(df, chunk=F.floor(F.col("report_seq") / width)).orderBy("report_seq")
        assert [r["dominant_category"] for r in got.collect()] == ["a", "a", "a", "b"]


def test_leaderboard_order(spark):
    table = spark.createDataFrame([(3, 0.5), (1, 0.5), (2, 0.9)], "user_id long, score double").selectExpr(
        "*", "3.0D as alpha", "2.0D as beta", "1L as total_reports", "'tier_1' as tier")
    assert [(r["rank"], r["user_id"]) for r in ops.leaderboard(table, 2).collect()] == [(1, 2), (2, 1)]


def test_missing_stream_list_counts_as_empty(spark):
    listed = spark.createDataFrame([("p", 0.9)], "phone_number string, weighted_score double")
    assert [r["entries"] for r in ops.merged_blacklist(listed, None).collect()] == [1]
