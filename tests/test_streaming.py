"""Streaming operators, run to the end of a finite set of files."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from callsieve.operators import burst, live, reputation
from callsieve.operators.complaints import FEATURES
from callsieve.sources import files, streams, views
from callsieve.streaming import blacklist
from callsieve.streaming import reputation as live_reputation

SF = "/root/testdata/sf0.001"
MONDAY = datetime.datetime(2026, 8, 3, tzinfo=datetime.timezone.utc).timestamp()
EVENT = ("event_id string, phone_number string, caller_country string, callee_country string, call_duration_sec int,"
         " is_voip boolean, timestamp double, device_fingerprint string, sms_content_hash string, produced_at double")


def event(phone, hour, voip=True, duration=3, country="MM", n=0, event_id=None):
    return (event_id or f"{phone}-{hour}-{n}", phone, country, "TW", duration, voip, MONDAY + hour * 3600 + n, "dev", "",
            MONDAY + hour * 3600 + n)


def write_events(spark, path, rows):
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").json(str(path))


def by_rule(df):
    return df.withColumn("probability", live.rule_score())


def run(stream, out, checkpoint):
    query = streams.append_parquet(stream, str(out), str(checkpoint))
    query.awaitTermination()
    return query


def test_listing_gate_and_restart(spark, tmp_path):
    scam = [event("scam", 3, n=i) for i in range(50)]
    normal = [event("shop", 10, voip=False, duration=300, country="TW", n=i) for i in range(5)]
    once = [event("once", 3)]
    write_events(spark, tmp_path / "in", scam + normal + once)
    log, check = tmp_path / "log", tmp_path / "check"

    def listed():
        events = streams.events_from_json(spark, str(tmp_path / "in"), 1)
        run(blacklist.blacklist_stream(events, by_rule, 0.5), log, check)
        return {r["phone_number"]: r for r in live.latest_blacklist(files.read_or_none(spark, str(log))).collect()}

    first = listed()
    assert set(first) == {"scam"}
    assert first["scam"]["calls_observed"] == 50 and first["scam"]["probability"] == 1.0
    # The second run resumes from the checkpoint: the single caller passes the gate with four more calls.
    write_events(spark, tmp_path / "in", [event("once", 3, n=10 + i) for i in range(4)])
    assert set(listed()) == {"scam", "once"}
    entries = spark.read.parquet(str(log))
    assert entries.count() == 2  # the unchanged number is not written again
    report = blacklist.stream_report(entries, 60).first()
    assert report["listed_numbers"] == 2 and report["p50_ms"] <= report["p99_ms"]


def test_stream_scoring_with_a_fitted_pipeline(spark, tmp_path):
    from callsieve.operators import ml

    rows = spark.range(40).select(
        F.col("id").cast("string").alias("row_id"), (F.col("id") % 2).cast("int").alias("label"),
        *[((F.col("id") % 2) * 0.9 if f in ("night_ratio", "is_voip") else F.lit(0.0) + (F.col("id") % 3) * 0.01).alias(f)
          for f in FEATURES])
    model = ml.fit_lr(rows, FEATURES)
    files.save_model(model, str(tmp_path / "model"), 0.5, FEATURES)
    loaded, threshold, names = files.load_model(spark, str(tmp_path / "model"))
    assert names == FEATURES and threshold == 0.5
    assert (ml.score(loaded, rows).agg(F.sum("score")).first()[0]
            == pytest.approx(ml.score(model, rows).agg(F.sum("score")).first()[0]))
    write_events(spark, tmp_path / "in", [event("scam", 3, n=i) for i in range(6)] + [
        event("shop", 10, voip=False, duration=300, n=i) for i in range(6)])
    events = streams.events_from_json(spark, str(tmp_path / "in"))
    scored = blacklist.blacklist_stream(
        events, lambda df: ml.score(loaded, df).withColumnRenamed("score", "probability"), threshold)
    run(scored, tmp_path / "log", tmp_path / "check")
    assert [r["phone_number"] for r in spark.read.parquet(str(tmp_path / "log")).collect()] == ["scam"]


def test_stream_features_equal_the_batch_state(spark, tmp_path):
    calls = views.calls(spark, SF).withColumn("timestamp", F.unix_micros("ts") / 1_000_000).withColumn(
        "event_id", F.col("call_id").cast("string")).withColumn("produced_at", F.lit(0.0))
    for part in range(3):
        calls.filter(F.floor(F.col("call_id") / 400) == part).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    events = streams.events_from_json(spark, str(tmp_path / "in"), 1)
    run(blacklist.feature_stream(events), tmp_path / "out", tmp_path / "check")
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("phone_number").agg(
        F.max_by(F.struct("total_calls", *FEATURES), "total_calls").alias("s")).select("phone_number", "s.*")
    want = live.running_features(views.calls(spark, SF)).groupBy("phone_number").agg(
        F.max_by(F.struct("total_calls", *FEATURES), "total_calls").alias("s")).select("phone_number", "s.*")
    tidy = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())
    assert tidy(got) == tidy(want)


def test_native_number_state_and_bounded_run(spark, tmp_path):
    write_events(spark, tmp_path / "in", [event("a", 23), event("a", 3), event("a", 10, voip=False), event("b", 10)])
    query = (blacklist.number_state(streams.events_from_json(spark, str(tmp_path / "in"))).writeStream.format("memory")
             .queryName("number_state").outputMode("complete").option("checkpointLocation", str(tmp_path / "check"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert not query.isActive
    row = spark.table("number_state").filter("phone_number = 'a'").first()
    assert (row["total_calls"], row["voip_calls"], row["night_calls"], row["business_calls"]) == (3, 2, 2, 1)


def test_repeated_event_ids_are_dropped(spark, tmp_path):
    rows = [event("a", 3, event_id="x"), event("a", 3, event_id="x"), event("a", 3, event_id="y")]
    write_events(spark, tmp_path / "in", rows)
    stream = streams.deduplicated(streams.events_from_json(spark, str(tmp_path / "in")))
    run(stream.select("event_id"), tmp_path / "out", tmp_path / "check")
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["x", "y"]


def test_replay_needs_a_fresh_checkpoint(spark, tmp_path):
    write_events(spark, tmp_path / "in", [event("a", 3, n=i) for i in range(3)])
    stream = lambda: streams.events_from_json(spark, str(tmp_path / "in")).select("event_id")
    run(stream(), tmp_path / "log1", tmp_path / "check1")
    run(stream(), tmp_path / "log1", tmp_path / "check1")
    run(stream(), tmp_path / "log2", tmp_path / "check2")
    assert spark.read.parquet(str(tmp_path / "log1")).count() == spark.read.parquet(str(tmp_path / "log2")).count() == 3


def test_published_messages_carry_the_production_time(spark, tmp_path):
    streams.publish(spark.createDataFrame([event("a", 3)], EVENT).drop("produced_at"), str(tmp_path / "in"))
    assert spark.read.json(str(tmp_path / "in")).first()["produced_at"] > MONDAY - 10 * 365 * 86400


def test_streaming_reputation_equals_batch(spark, tmp_path):
    reports, validations = views.reports(spark, SF), views.validations(spark, SF)
    mixed = live_reputation.mixed_stream(reports, validations)
    path = str(tmp_path / "in")
    for part in range(2):
        rows = mixed.filter((F.col("seq") >= part * 500) & (F.col("seq") < (part + 1) * 500))
        rows.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(mixed.schema).option("maxFilesPerTrigger", 1).parquet(path)
    run(live_reputation.report_stream(stream), tmp_path / "out", tmp_path / "check")
    got = spark.read.parquet(str(tmp_path / "out"))
    reporters = reports.select("user_id", "registered_country").distinct()
    batch = reputation.report_decisions(reports, validations, reporters).filter("status = 'accepted'")
    pick = lambda df, key: sorted((r[0], r[1], round(r[2], 9), r[3]) for r in df.select(
        key, "burst_count", "reputation", "user_weight").collect())
    assert pick(got.filter("accepted"), "seq") == pick(batch, "report_seq")
    held = burst.burst_throttle(reports).filter("not accepted").count()
    assert got.filter("not accepted").count() == held
