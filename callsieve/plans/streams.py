"""Bounded streams over files: calls and reports are written as message files, out of order and repeated, and streamed to their end."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import live
from ..session import cut_lineage, scratch
from ..sources import streams, views
from ..streaming import blacklist, consensus, eventlog
from ..streaming.ordered import ROCKS
from ..streaming.store import BlacklistStore
from .evaluation import rounded
from .live import COUNTS, GATED, SCORED
from .oracle_views import over
from .registry import ORACLES, query

PARTS, FILE_ROWS = 3, 200_000
#: Events that only move the clock: behind all others, from a number that is never listed.
CLOCK = "clock"


def messages(spark, sf):
    """Call events with their time, and the message columns."""
    for name, value in ROCKS.items():
        spark.conf.set(name, value)
    return views.calls(spark, sf).select(
        F.lpad(F.col("call_id").cast("string"), 20, "0").alias("event_id"), "phone_number", "caller_country", "callee_country",
        F.col("call_duration_sec").cast("int").alias("call_duration_sec"), "is_voip", (F.unix_micros("ts") / 1_000_000).alias("timestamp"),
        F.col("device_fp").alias("device_fingerprint"), "sms_content_hash", F.lit(0.0).alias("produced_at"))


def sent(spark, sf, shuffled: bool = True):
    """Message files in arrival order: thirds of the time span, one in ten events a third late, one in seven sent twice. Also the delay that covers it."""
    events = messages(spark, sf)
    low, high, n = events.agg(F.min("timestamp"), F.max("timestamp"), F.count("*")).first()
    span = (high - low) / PARTS if n else 1.0
    lot = F.pmod(F.xxhash64("event_id"), F.lit(70))
    part = F.least(F.floor((F.col("timestamp") - low) / span), F.lit(PARTS - 1))
    if shuffled:
        late = F.when(lot % 10 == 0, 1).otherwise(0)
        arrivals = F.when(lot % 7 == 0, F.array(part + late, part + 1)).otherwise(F.array(part + late))
    else:
        arrivals = F.array(part)
    path, n_files = scratch(spark, "messages"), max(1, -(-n // (PARTS * FILE_ROWS)))
    marked = events.select("*", F.explode(arrivals).alias("_part"))
    for i in range(PARTS + shuffled):
        marked.filter(F.col("_part") == i).drop("_part").repartition(n_files).write.mode("append").json(path)
    clock = [(f"z{i}", CLOCK, "TW", "TW", 100, False, (high or 0.0) + (i + 1) * 10.0 * (span + 3600) * PARTS, "", "", 0.0) for i in range(2)]
    for row in clock:
        spark.createDataFrame([row], events.schema).coalesce(1).write.mode("append").json(path)
    return path, n_files, f"{math.ceil(2 * span) + 60} seconds"


def finished(query_):
    query_.awaitTermination()
    return query_


def by_rule(df):
    return df.withColumn("probability", live.rule_score())


def logged(spark, sf):
    path, n_files, delay = sent(spark, sf)
    store = BlacklistStore(spark, scratch(spark, "blacklist"))
    log = eventlog.event_log(streams.events_from_json(spark, path, n_files), by_rule, 0.5, delay=delay)
    finished(eventlog.keep(log, store))
    return store


WRITTEN = {"c": COUNTS, "s": SCORED, "g": GATED, "l": """
select *, row_number() over (partition by phone_number order by ts, call_id) as rn from g""", "walk": """
select phone_number, rn, probability as last_p, true as written from l where rn = 1
union all
select l.phone_number, l.rn, case when abs(l.probability - w.last_p) > 0.01::double then l.probability else w.last_p end,
  abs(l.probability - w.last_p) > 0.01::double
from walk w join l on l.phone_number = w.phone_number and l.rn = w.rn + 1""",
           "entries": "select l.call_id, l.phone_number, l.total_calls, l.probability from walk join l using (phone_number, rn) where walk.written"}


@query("stream_blacklist", over("calls", "select * from entries", **WRITTEN))
def stream_blacklist(spark, sf):
    """Entries of the streamed blacklist over late, unordered and repeated events: those of the ordered batch."""
    return logged(spark, sf).history().select(F.col("event_id").cast("long").alias("call_id"), "phone_number",
                                              F.col("calls_observed").alias("total_calls"), "probability")


@query("stream_report", over("calls", """
select (select count(*) from calls) + 1 as events, count(*) as entries_written, count(distinct phone_number) as listed_numbers,
  true as in_order, true as no_producer from entries""", **WRITTEN))
def stream_report(spark, sf):
    """Totals that the stream counted itself (one clock event included), and whether its latency figures are in order."""
    figures = eventlog.report(spark, logged(spark, sf))
    p50, p95, p99 = (F.col(f"processing_{p}_ms") for p in ("p50", "p95", "p99"))
    return figures.select("events", "entries_written", "listed_numbers", ((p50 > 0) & (p50 <= p95) & (p95 <= p99)).alias("in_order"),
                          F.col("end_to_end_p50_ms").isNull().alias("no_producer"))


@query("blacklist_versions", over("calls", """
select phone_number, arg_max(probability, total_calls) as probability, max(total_calls) as calls_observed, 2 as versions from entries group by 1""", **WRITTEN))
def blacklist_versions(spark, sf):
    """The current list read from a snapshot and what was written after it, after two compactions."""
    store = logged(spark, sf)
    store.compact()
    version = store.compact()
    return store.current().select("phone_number", "probability", "calls_observed", F.lit(version + 1).alias("versions"))


@query("stream_number_state", over("calls", """
select phone_number, count(*) as total_calls, cast(sum(is_voip::int) as bigint) as voip_calls,
  cast(sum((hour(ts) >= 22 or hour(ts) < 6)::int) as bigint) as night_calls, count(distinct caller_country) as countries
from calls group by 1"""))
def stream_number_state(spark, sf):
    """Running counters per number as a streaming aggregate: each batch upserts the numbers that it saw."""
    path, n_files, _ = sent(spark, sf, shuffled=False)
    state = blacklist.number_state(streams.events_from_json(spark, path, n_files))
    out = scratch(spark, "states")

    def upsert(rows, number):
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    finished(state.writeStream.foreachBatch(upsert).outputMode("update").option("checkpointLocation", scratch(spark, "check"))
             .trigger(availableNow=True).start())
    columns = ["total_calls", "voip_calls", "night_calls", "countries"]
    newest = spark.read.parquet(out).filter(F.col("phone_number") != CLOCK).groupBy("phone_number").agg(F.max_by(F.struct(*columns), "batch").alias("s"))
    return newest.select("phone_number", "s.*")


@query("stream_source_json", over("calls", """
select call_id, phone_number, caller_country, call_duration_sec::integer as call_duration_sec, is_voip, 2 as replays from calls"""))
def stream_source_json(spark, sf):
    """Events as the source reads them; a second run with a checkpoint of its own replays all of them."""
    path, n_files, _ = sent(spark, sf, shuffled=False)
    out = scratch(spark, "replays")
    for i in range(2):
        events = streams.events_from_json(spark, path, n_files).filter(F.col("phone_number") != CLOCK)
        finished(streams.append_parquet(events, f"{out}/replay={i}", scratch(spark, "check")))
    columns = ["phone_number", "caller_country", "call_duration_sec", "is_voip"]
    seen = spark.read.parquet(out).groupBy("event_id").agg(F.count_distinct("replay").cast("int").alias("replays"), F.min(F.struct(*columns)).alias("e"))
    return seen.select(F.col("event_id").cast("long").alias("call_id"), "e.*", "replays")


@query("stream_bounded_run", over("calls", "select call_id, 1 as seen from calls"))
def stream_bounded_run(spark, sf):
    """A run stops when its input is read; a later run with the same checkpoint takes only what has come since."""
    events, path, out, check = messages(spark, sf), scratch(spark, "messages"), scratch(spark, "log"), scratch(spark, "check")
    for i in range(2):
        events.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == i).write.mode("append").json(path)
        finished(streams.append_parquet(streams.events_from_json(spark, path, 1000).select("event_id"), out, check))
    return spark.read.parquet(out).groupBy(F.col("event_id").cast("long").alias("call_id")).agg(F.count("*").cast("int").alias("seen"))


@query("stream_dedup", over("calls", "select call_id, phone_number from calls"))
def stream_dedup(spark, sf):
    """Late and repeated events, each once."""
    path, n_files, delay = sent(spark, sf)
    out = scratch(spark, "log")
    events = streams.events_from_json(spark, path, n_files).filter(F.col("phone_number") != CLOCK)
    finished(streams.append_parquet(streams.deduplicated(events, delay).select("event_id", "phone_number"), out, scratch(spark, "check")))
    return spark.read.parquet(out).select(F.col("event_id").cast("long").alias("call_id"), "phone_number")


@query("stream_reports", ORACLES["report_decisions"])
def stream_reports(spark, sf):
    """Decisions on streamed reports, which come out of order, validations beside them: those of the ordered batch."""
    messages(spark, sf)
    given = {"reports": (views.reports(spark, sf), "report_seq"), "validations": (views.validations(spark, sf), "seq")}
    ends = [df.agg(F.coalesce(F.min("t"), F.lit(0.0)), F.coalesce(F.max("t"), F.lit(0.0))).first() for df, _ in given.values()]
    first, last = min(e[0] for e in ends), max(e[1] for e in ends)
    delay = math.ceil(last - first) + 60
    made = []
    for df, seq in given.values():
        path = scratch(spark, "reports")
        df = cut_lineage(df)
        for i in range(PARTS):
            df.filter(F.pmod(F.xxhash64(seq), F.lit(PARTS)) == i).write.mode("append").parquet(path)
        # Two rows that only move the clock.
        for i in range(2):
            df.limit(1).withColumns({seq: F.lit(-1 - i).cast("long"), "user_id": F.lit(0).cast("long"), "t": F.lit(last + 10.0 * delay * (i + 1))}).write.mode("append").parquet(path)
        made.append(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1000).parquet(path))
    out = scratch(spark, "decisions")
    decided = consensus.decision_stream(*made, views.reporters(spark, sf), delay=f"{delay} seconds")
    finished(streams.append_parquet(decided, out, scratch(spark, "check")))
    return rounded(spark.read.parquet(out).filter("report_seq >= 0"))
