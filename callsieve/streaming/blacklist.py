"""Streaming blacklist: number state, features, scoring, gate and write suppression.

Per micro-batch one row leaves the state operator for every number seen. Flags are computed natively
before it, so the Python side only adds up columns. Sources bound the batch size (files or offsets per
trigger), which also bounds what a hot number brings per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.live import MIN_CALLS, WRITE_STEP, event_counters, state_features
from ..operators.quantiles import exact_quantiles

COUNTERS = ["total_calls", "voip_calls", "short_calls", "business_calls", "evening_calls", "night_calls", "school_calls",
            "weekend_calls"]
STATE_SCHEMA = ", ".join(f"{c} long" for c in COUNTERS) + ", countries array<string>"
STATE_OUTPUT = "phone_number string, " + ", ".join(f"{c} long" for c in COUNTERS) + ", countries long, produced_at double"
ENTRY_SCHEMA = ("phone_number string, probability double, threshold double, calls_observed long, blacklisted_at double,"
                " source string, produced_at double")


def number_state(events: DataFrame) -> DataFrame:
    """Running counters per number as a native streaming aggregate (update mode)."""
    counted = events.select("phone_number", F.coalesce("caller_country", F.lit("")).alias("country"), "ts",
                            *[c.alias(n) for n, c in event_counters().items()])
    return counted.groupBy("phone_number").agg(
        *[F.sum(c).alias(c) for c in COUNTERS], F.size(F.collect_set("country")).cast("long").alias("countries"),
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


class NumberCounters(StatefulProcessor):
    """Adds a batch's flags to the number's counters and emits them."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("counters", STATE_SCHEMA, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        known = self.state.get() if self.state.exists() else (*[0] * len(COUNTERS), [])
        counts, countries, newest = list(known[:-1]), set(known[-1]), 0.0
        for pdf in rows:
            counts = [int(a + b) for a, b in zip(counts, pdf[COUNTERS].sum())]
            countries.update(pdf["country"])
            newest = max(newest, float(pdf["produced_at"].max()))
        self.state.update((*counts, sorted(countries)))
        yield pd.DataFrame([(key[0], *counts, len(countries), newest)],
                           columns=["phone_number", *COUNTERS, "countries", "produced_at"])

    def close(self) -> None:
        pass


class ListedNumbers(StatefulProcessor):
    """Emits a blacklist entry on first listing or when the probability moved more than the step."""

    def __init__(self, threshold: float, min_calls: int, step: float, ttl_ms: int | None = None):
        self.threshold, self.min_calls, self.step, self.ttl_ms = threshold, min_calls, step, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "probability double", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        out, last = [], self.last.get()[0] if self.last.exists() else None
        for pdf in rows:
            for r in pdf.sort_values("total_calls").itertuples():
                listed = r.probability >= self.threshold and r.total_calls >= self.min_calls
                if listed and (last is None or abs(r.probability - last) > self.step):
                    last = float(r.probability)
                    out.append((key[0], last, self.threshold, int(r.total_calls), float(r.seen_at), "blacklist_stream",
                                float(r.produced_at)))
        if out:
            self.last.update((last,))
        columns = [c.split()[0] for c in ENTRY_SCHEMA.split(", ")]
        yield pd.DataFrame(out, columns=columns)

    def close(self) -> None:
        pass


def stateful(stream: DataFrame, key: str, processor: StatefulProcessor, schema: str, ttl_ms: int | None) -> DataFrame:
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None")


def feature_stream(events: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """The 20 features of every number seen in a batch, with ``total_calls``."""
    flags = events.select("phone_number", F.coalesce("caller_country", F.lit("")).alias("country"),
                          F.coalesce("produced_at", F.lit(0.0)).alias("produced_at"),
                          *[c.alias(n) for n, c in event_counters().items()])
    states = stateful(flags, "phone_number", NumberCounters(ttl_ms), STATE_OUTPUT, ttl_ms)
    return states.select("phone_number", "total_calls", "produced_at", *[c.alias(n) for n, c in state_features().items()])


def blacklist_stream(events: DataFrame, add_score: Callable[[DataFrame], DataFrame], threshold: float,
                     min_calls: int = MIN_CALLS, step: float = WRITE_STEP, ttl_ms: int | None = None) -> DataFrame:
    """Change log of the blacklist. ``add_score`` adds ``probability``, by a rule or a fitted pipeline."""
    scored = add_score(feature_stream(events, ttl_ms)).select(
        "phone_number", "total_calls", F.round("probability", 4).alias("probability"), "produced_at",
        (F.unix_micros(F.current_timestamp()) / 1_000_000).alias("seen_at"))
    return stateful(scored, "phone_number", ListedNumbers(threshold, min_calls, step, ttl_ms), ENTRY_SCHEMA, ttl_ms)


def stream_report(log: DataFrame, events: int) -> DataFrame:
    """Events seen, numbers listed, entries written and end-to-end latency of the written entries."""
    known = log.withColumn("ms", F.when(F.col("produced_at") > 0, (F.col("blacklisted_at") - F.col("produced_at")) * 1000))
    p50, p95, p99 = exact_quantiles(known, {"ms": F.col("ms")}, [0.5, 0.95, 0.99])["ms"]
    return known.agg(F.lit(events).cast("long").alias("events"), F.count_distinct("phone_number").alias("listed_numbers"),
                     F.count("*").alias("entries_written")).select(
        "*", *[F.lit(v).cast("double").alias(n) for n, v in (("p50_ms", p50), ("p95_ms", p95), ("p99_ms", p99))])
