"""Per-event running features of numbers and the blacklist write rules, as batch operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .complaints import FEATURES
from .prefix import matched, running

MIN_CALLS, WRITE_STEP = 5, 0.01


def hour_chunk() -> Column:
    return F.date_trunc("hour", "ts")


def event_counters() -> dict[str, Column]:
    """0/1 contribution of one call event to each counter of its number."""
    hour = F.hour("ts")
    tests = {
        "total_calls": F.lit(True), "voip_calls": F.col("is_voip"), "short_calls": F.col("call_duration_sec") < 30,
        "business_calls": (hour >= 9) & (hour < 17), "evening_calls": (hour >= 18) & (hour < 22),
        "night_calls": (hour >= 22) | (hour < 6), "school_calls": (hour >= 8) & (hour < 15),
        "weekend_calls": F.weekday("ts") >= 5,
    }
    return {n: F.coalesce(t, F.lit(False)).cast("long") for n, t in tests.items()}


def state_features() -> dict[str, Column]:
    """The 20 features from a number's counters; those that call events cannot give are 0."""
    share = lambda name: F.col(name) / F.greatest("total_calls", F.lit(1))
    known = {
        "business_hour_ratio": share("business_calls"), "evening_ratio": share("evening_calls"),
        "night_ratio": share("night_calls"), "school_hour_ratio": share("school_calls"),
        "weekend_ratio": share("weekend_calls"), "prerecorded_ratio": share("short_calls"),
        "abandoned_call_ratio": share("short_calls"), "live_voice_ratio": 1.0 - share("short_calls"),
        "is_voip": share("voip_calls"), "unique_states_norm": F.least(F.col("countries") / 10.0, F.lit(1.0)),
    }
    return {n: known.get(n, F.lit(0.0)) for n in FEATURES}


def rule_score(columns: dict[str, Column] | None = None) -> Column:
    """Fixed weighting of night, VoIP and short calls, used where no trained model is given."""
    c = columns or {n: F.col(n) for n in FEATURES}
    return F.round(0.4 * c["night_ratio"] + 0.4 * c["is_voip"] + 0.2 * c["prerecorded_ratio"], 4)


def running_features(calls: DataFrame) -> DataFrame:
    """State of the number after each of its calls, with the 20 features.

    The distinct countries so far are a running count of first calls per country: those few rows are
    added once as markers, instead of keeping a growing set per row.
    """
    columns = ["call_id", "phone_number", "ts"]
    counters = event_counters()
    rows = calls.select(*columns, *[c.alias(n) for n, c in counters.items()], F.lit(0).cast("long").alias("countries"))
    first = (calls.groupBy("phone_number", F.coalesce("caller_country", F.lit("")).alias("country"))
             .agg(F.min(F.struct("ts", "call_id")).alias("f")).select(
        "f.call_id", "phone_number", "f.ts", *[F.lit(0).cast("long").alias(n) for n in counters],
        F.lit(1).cast("long").alias("countries")))
    states = [*counters, "countries"]
    table = running(rows.unionByName(first).withColumnsRenamed({s: f"d_{s}" for s in states}), ["phone_number"],
                    [F.col("ts"), F.col("call_id"), F.col("d_total_calls")], hour_chunk(),
                    sums={s: F.col(f"d_{s}") for s in states}).filter("d_total_calls = 1")
    return table.select(*columns, "total_calls", *[c.alias(n) for n, c in state_features().items()])


def gate(scored: DataFrame, threshold: float, min_calls: int = MIN_CALLS) -> DataFrame:
    """Events that may list their number: probable enough, and enough calls seen."""
    return scored.filter((F.col("probability") >= threshold) & (F.col("total_calls") >= min_calls))


def entry_table(probabilities: np.ndarray, step: float) -> list[tuple[float, float]]:
    """What a chunk does to the value written last before it: (value, last written value after the chunk) in order of time.

    An earlier value e is overwritten by the first event more than ``step`` away, and what follows depends on that event alone. It is a new
    highest or lowest value of the chunk, so those records are all that can overwrite, and none is needed past the first that
    overwrites every e which the first event has left alone. When no record is far enough from e, e stays.
    """
    p = probabilities
    highs, lows = np.maximum.accumulate(p), np.minimum.accumulate(p)
    record = np.concatenate([[True], (p[1:] > highs[:-1]) | (p[1:] < lows[:-1])])
    places = np.flatnonzero(record)
    far_up, far_down = (np.flatnonzero(x)[:1] for x in (p[places] - p[0] > 2 * step + 1e-9, p[0] - p[places] > 2 * step + 1e-9))
    if len(far_up) and len(far_down):
        places = places[:max(far_up[0], far_down[0]) + 1]
    state = p[places].copy()
    for i, value in enumerate(p):
        state = np.where((places < i) & ~(np.abs(state - value) <= step), value, state)
    return list(zip(p[places].tolist(), state.tolist()))


def write_dedup(gated: DataFrame, step: float = WRITE_STEP) -> DataFrame:
    """Events written to the blacklist: the first, then those more than ``step`` from the last written.

    What is written depends on the last write, so it looks like one long fold per number. Each hour of a number is first reduced to a
    small table "last value before -> last value after" (:func:`entry_table`). Walking these tables in time order gives every hour its
    starting value, and then all hours are worked through in parallel. Rows without a time come first; rows without a
    probability are never written.
    """
    schema = gated.schema
    hour = F.coalesce(F.unix_micros(F.date_trunc("hour", "ts")), F.lit(-(2 ** 62)))
    rows = gated.filter(F.col("probability").isNotNull()).withColumn("chunk", hour)
    key, order = ["phone_number", "chunk"], ["ts", "call_id"]

    def tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []

        def done() -> list[tuple]:
            return [(*now, i, value, after) for i, (value, after) in enumerate(entry_table(np.array(held), step))]

        for pdf in batches:
            out = []
            for *own, p in zip(pdf["phone_number"], pdf["chunk"], pdf["probability"]):
                if own != now:
                    out += done() if held else []
                    now, held = own, []
                held.append(p)
            yield pd.DataFrame(out, columns=["phone_number", "chunk", "place", "value", "after"])
        if held:
            yield pd.DataFrame(done(), columns=["phone_number", "chunk", "place", "value", "after"])

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = chunk = None
        started = settled = False
        last = after = np.nan
        for pdf in batches:
            starts = []
            for phone, own, value, then in zip(pdf["phone_number"], pdf["chunk"], pdf["value"], pdf["after"]):
                if not started or phone != number or own != chunk:
                    last = after if started and phone == number else np.nan
                    number, chunk, started, settled, after = phone, own, True, False, last
                    starts.append((phone, own, last))
                if not settled and not abs(value - last) <= step:
                    settled, after = True, then
            yield pd.DataFrame(starts, columns=["phone_number", "chunk", "last"])

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, last = None, np.nan
        for pdf in batches:
            keep = np.zeros(len(pdf), bool)
            for i, (*own, before, p) in enumerate(zip(pdf["phone_number"], pdf["chunk"], pdf["last"], pdf["probability"])):
                if own != now:
                    now, last = own, before
                if not abs(p - last) <= step:
                    keep[i], last = True, p
            yield pdf.loc[keep, schema.names]

    def dealt(df: DataFrame, by: list[str], then: list[str]) -> DataFrame:
        return df.repartition(*by).sortWithinPartitions(*by, *then)

    exits = dealt(rows.select(*key, *order, "probability"), key, order).mapInPandas(
        tables, "phone_number string, chunk long, place long, value double, after double")
    starts = dealt(exits, ["phone_number"], ["chunk", "place"]).mapInPandas(walk, "phone_number string, chunk long, last double")
    return dealt(matched(rows, starts, key), key, order).mapInPandas(write, schema)


def latest_blacklist(log: DataFrame) -> DataFrame:
    """Current entry per number from the append-only change log."""
    return log.groupBy("phone_number").agg(F.max_by(F.struct(*[c for c in log.columns if c != "phone_number"]),
                                                    "calls_observed").alias("e")).select("phone_number", "e.*")
