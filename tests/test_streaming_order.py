"""Late and unordered streams against the batch operators; versions of the blacklist; latency of every event."""

from __future__ import annotations

import datetime
import random
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from callsieve.operators import live, reputation
from callsieve.sources import streams, views
from callsieve.streaming import consensus, eventlog
from callsieve.streaming.store import BlacklistStore

SF = "/root/testdata/sf0.001"
START = datetime.datetime(2026, 8, 3, 3, tzinfo=datetime.timezone.utc).timestamp()
EVENT = ("event_id string, phone_number string, caller_country string, callee_country string, call_duration_sec int,"
         " is_voip boolean, timestamp double, device_fingerprint string, sms_content_hash string, produced_at double")


def event(i, phone, at, voip=True, duration=3, country="MM"):
    return (f"e{i:05d}", phone, country, "TW", duration, voip, START + at, "dev", "", START + at)


def some_events(seed=1, n=400):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        phone = rng.choice(["hot", "hot", "hot", "a", "b", "c"])
        out.append(event(i, phone, i * 20 + rng.random(), rng.random() < 0.7, rng.choice([3, 10, 90]), rng.choice(["MM", "TW", "US", None])))
    return out


def scored(df):
    return df.withColumn("probability", live.rule_score())


def write_batches(spark, path, batches, schema=EVENT):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(path))


def finished(query):
    query.awaitTermination()
    assert query.exception() is None


def run_log(spark, tmp_path, batches, name, **kwargs):
    """The entries that the batches give; a last event far ahead moves the watermark past all others."""
    far = [event(99_999, "clock", 10 ** 6)]
    write_batches(spark, tmp_path / name / "in", [*batches, far, [event(99_998, "clock", 2 * 10 ** 6)]])
    store = BlacklistStore(spark, str(tmp_path / name / "store"))
    events = streams.events_from_json(spark, str(tmp_path / name / "in"), 1)
    finished(eventlog.keep(eventlog.event_log(events, scored, 0.5, **kwargs), store))
    return store


def batch_entries(spark, rows):
    calls = spark.createDataFrame(rows, EVENT).dropDuplicates(["event_id"]).withColumn("ts", F.timestamp_seconds("timestamp")).withColumn("call_id", F.col("event_id"))
    trace = live.running_features(calls).select("call_id", "phone_number", "ts", "total_calls", live.rule_score().alias("probability"))
    return sorted((r["phone_number"], r["call_id"], r["total_calls"], r["probability"]) for r in live.write_dedup(live.gate(trace, 0.5)).collect())


def entries(store):
    return sorted((r["phone_number"], r["event_id"], r["calls_observed"], r["probability"]) for r in store.history().collect())


def test_shuffled_and_repeated_input_gives_the_log_of_sorted_input(spark, tmp_path):
    rows = some_events()
    want = batch_entries(spark, rows)
    assert len(want) > 5
    rng = random.Random(2)
    mixed = rows + rng.sample(rows, 60)
    rng.shuffle(mixed)
    size = len(mixed) // 4
    shuffled = [mixed[i * size:(i + 1) * size + (3 if i == 3 else 0)] for i in range(4)]
    for name, batches in (("sorted", [rows[:200], rows[200:]]), ("shuffled", shuffled)):
        store = run_log(spark, tmp_path, batches, name, delay="3 hours")
        assert entries(store) == want, name
        # Every event is counted once; the two that move the clock have come in, and the last still waits.
        assert eventlog.report(spark, store).first()["events"] == len(rows) + 1


def test_a_number_is_forgotten_when_idle(spark, tmp_path):
    early = [event(i, "x", i) for i in range(6)]
    late = [event(100 + i, "x", 86_400 + i) for i in range(6)]
    step = [event(500, "clock", 30_000)]
    kept = run_log(spark, tmp_path, [early, step, late], "kept", delay="10 seconds")
    assert [e[1:3] for e in entries(kept)] == [("e00004", 5)]
    gone = run_log(spark, tmp_path, [early, step, late], "gone", delay="10 seconds", idle_s=3600)
    assert [e[1:3] for e in entries(gone)] == [("e00004", 5), ("e00104", 5)]


def test_report_has_every_event_and_its_latency(spark, tmp_path):
    rows = some_events(3, 300)
    store = run_log(spark, tmp_path, [rows[:150], rows[150:]], "r", delay="1 minute")
    found = eventlog.report(spark, store).first()
    assert (found["events"], found["entries_written"]) == (301, len(batch_entries(spark, rows)))
    assert 0 < found["processing_p50_ms"] <= found["processing_p95_ms"] <= found["processing_p99_ms"] < 600_000
    assert found["end_to_end_p50_ms"] <= found["end_to_end_p99_ms"]
    none = BlacklistStore(spark, str(tmp_path / "nothing"))
    empty = eventlog.report(spark, none).first()
    assert (empty["events"], empty["listed_numbers"], empty["processing_p50_ms"]) == (0, 0, None)


def test_merged_sketches_are_within_their_rank_error(spark):
    values = spark.range(100_000).select((F.pow(F.rand(5), 3) * 1000).alias("v"), (F.col("id") % 37).alias("batch")).cache()
    sketches = values.groupBy("batch").agg(F.kll_sketch_agg_double("v", F.lit(eventlog.SKETCH_K)).alias("s"))
    got = sketches.agg(F.kll_merge_agg_double("s").alias("s")).select(
        *[F.kll_sketch_get_quantile_double("s", F.lit(q)).alias(f"q{i}") for i, q in enumerate((0.5, 0.95, 0.99))]).first()
    for value, q in zip(got, (0.5, 0.95, 0.99)):
        assert abs(values.filter(F.col("v") <= value).count() / 100_000 - q) < 0.02


def entry_rows(spark, store, batch, rows):
    spark.createDataFrame(rows, "phone_number string, probability double, calls_observed long, event_id string, blacklisted_at double, produced_at double, ts_us long"
                          ).write.parquet(store.delta(batch))


def test_snapshot_and_delta_equal_the_whole_log(spark, tmp_path):
    store = BlacklistStore(spark, str(tmp_path))
    assert store.current().count() == 0 and store.newest() == (-1, None, -1, 0)
    pick = lambda df: sorted((r["phone_number"], r["probability"], r["calls_observed"]) for r in df.collect())
    rng = random.Random(1)
    for batch in range(6):
        entry_rows(spark, store, batch, [(f"n{rng.randrange(8)}", rng.random(), batch * 10 + i, f"e{batch}-{i}", 0.0, 0.0, batch * 100 + i) for i in range(5)])
        whole = pick(store._latest(store.history()))
        assert pick(store.current()) == whole
        if batch in (1, 3):
            assert store.compact() == (0 if batch == 1 else 1)
            assert pick(store.current()) == whole
    assert store.newest()[:1] == (1,)


def test_a_reader_during_compaction_sees_one_version(spark, tmp_path):
    store = BlacklistStore(spark, str(tmp_path))
    entry_rows(spark, store, 0, [("a", 0.6, 5, "e1", 0.0, 0.0, 1)])
    store.compact()
    reader = store.current()  # looked up before the next compaction
    entry_rows(spark, store, 1, [("a", 0.9, 6, "e2", 0.0, 0.0, 2), ("b", 0.7, 5, "e3", 0.0, 0.0, 3)])
    store.compact()
    assert {r["phone_number"] for r in reader.collect()} == {"a"}
    assert {(r["phone_number"], r["probability"]) for r in store.current().collect()} == {("a", 0.9), ("b", 0.7)}
    # Two writers cannot publish one version.
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        store._publish(1, None, 5, 0)


def test_reset_opens_a_version_in_which_numbers_are_listed_again(spark, tmp_path):
    rows = [event(i, "x", i) for i in range(6)]
    store = run_log(spark, tmp_path, [rows], "s", delay="10 seconds")
    first = store.checkpoint()
    assert {r["phone_number"] for r in store.current().collect()} == {"x"}
    store.reset()
    assert store.current().count() == 0 and store.history().count() == 1 and store.checkpoint() != first
    events = streams.events_from_json(spark, str(tmp_path / "s" / "in"), 1)
    finished(eventlog.keep(eventlog.event_log(events, scored, 0.5, delay="10 seconds"), store))
    assert {r["phone_number"] for r in store.current().collect()} == {"x"} and store.history().count() == 2


@pytest.mark.parametrize("shuffled", [False, True])
def test_streamed_decisions_equal_the_batch(spark, tmp_path, shuffled):
    reports = views.reports(spark, SF).withColumn("scam_category", F.when(F.col("report_seq") % 50 != 0, F.col("scam_category")))
    validations, reporters = views.validations(spark, SF), views.reporters(spark, SF)
    both = {"r": (reports, "report_seq"), "v": (validations, "seq")}
    last = max(df.agg(F.max("t")).first()[0] for df, _ in both.values())
    made = {}
    for name, (df, seq) in both.items():
        part = (F.xxhash64(seq) if shuffled else F.col(seq)) % 3 if shuffled else F.floor(F.col(seq) / 400)
        clock = df.limit(1).withColumn(seq, F.lit(10 ** 9).cast("long")).withColumn("user_id", F.lit(0).cast("long")).withColumn("t", F.lit(last + 10.0 ** 8))
        if name == "r":
            clock = clock.withColumn("phone_number", F.lit("clock"))
        path, order = str(tmp_path / name), [part == i for i in (0, 1, 2, -1, -2)]
        for test in order:
            df.filter(test).coalesce(1).write.mode("append").parquet(path)
        if shuffled:
            df.sample(0.2, seed=1).coalesce(1).write.mode("append").parquet(path)
        clock.coalesce(1).write.mode("append").parquet(path)
        made[name] = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    stream = consensus.decision_stream(made["r"], made["v"], reporters, delay="400 days" if shuffled else "2 days")
    query = streams.append_parquet(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    finished(query)
    tidy = lambda df: sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.filter("report_seq < 1000000000").dropDuplicates(
        ["report_seq"]).fillna("-", ["dominant_category", "decision"]).fillna(-1).withColumn("geo_flag", F.col("geo_flag").cast("string")).fillna("-").select(
        sorted(df.columns)).collect())
    got, want = spark.read.parquet(str(tmp_path / "out")), reputation.report_decisions(reports, validations, reporters)
    assert tidy(got) == tidy(want)
    assert got.filter("status = 'error'").count() > 0


class MapState:
    def __init__(self):
        self.held, self.calls = {}, 0

    def getValue(self, key):
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.held[key] = value


def test_numbers_of_a_bucket_keep_apart_with_two_calls_each():
    """Each number has its own counters, whatever shares its state; a number's events and countries cost no call of their own."""
    counters = eventlog.OrderedCounters()
    counters.numbers = MapState()
    rows = [(phone, f"e{i:03d}", i, country) for phone in ("a", "b", "c") for i, country in enumerate(["TW", "US", "TW", "MM", ""])]
    frame = pd.DataFrame(rows, columns=["phone_number", "event_id", "ts_us", "country"]).assign(produced_at=0.0, arrived_at=0.0, **{c: 1 for c in eventlog.COUNTERS})
    for turn in range(2):
        out = pd.concat(counters.released((0,), frame))
        assert out["total_calls"].tolist() == [*range(1 + 5 * turn, 6 + 5 * turn)] * 3
        assert out["countries"].tolist() == ([1, 2, 2, 3, 4] if not turn else [4] * 5) * 3
        assert out["phone_number"].tolist() == frame["phone_number"].tolist()
    assert counters.numbers.calls == 2 * 2 * 3


def test_rows_that_wait_are_put_beside_those_that_wait_already():
    """What waits is not read again when rows come in, and one timer is set for them."""
    from callsieve.streaming.ordered import Held

    held, timers, part = Held(), [], MapState()
    held.pending, held.handle, held.done = part, SimpleNamespace(registerTimer=timers.append), {}
    count = {}
    held.parts = SimpleNamespace(exists=lambda: bool(count), get=lambda: (count["n"],), update=lambda v: count.update(n=v[0]))
    for turn in range(3):
        held.handleInputRows((0,), iter([pd.DataFrame({"ts_us": [5000 + turn, 9000]}), pd.DataFrame({"ts_us": [3000]})]), None)
    assert sorted(k for k, in part.held) == [0, 1, 2, 3, 4, 5] and part.calls == 6 and timers == [3, 3, 3]


def test_moves_are_those_of_a_row_by_row_walk():
    rng = random.Random(4)
    for n, spread in ((0, 1.0), (1, 1.0), (500, 0.02), (500, 1.0), (3000, 0.012)):
        p = [0.5 + spread * rng.random() for _ in range(n)]
        for start in (float("nan"), 0.5):
            want, last = [], start
            for i, x in enumerate(p):
                if not abs(x - last) <= 0.01:
                    want.append(i)
                    last = x
            assert eventlog.moves(np.array(p), start, 0.01) == want
