"""The blacklist kept event by event, whatever the order of arrival, with the latency of every event.

Events wait until the watermark has passed them, go once each and in order through their number's counters, are scored,
and meet the listing rules in order: the written entries are those of the batch rules ``gate`` and ``write_dedup``. Every event comes out, written or
not, so that one pass over a micro-batch gives the entries and a mergeable sketch of all latencies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import time

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.live import MIN_CALLS, WRITE_STEP, event_counters, state_features
from .blacklist import COUNTERS
from .ordered import Held, dated, in_order, ordered, sliced
from .store import BlacklistStore

#: Larger sketches are more exact: with 200 a quantile's rank is off by about 1.3 % at most (99 % confidence).
SKETCH_K = 200
#: Numbers share a state by their hash, since a state costs several calls to Spark in each batch, however few rows it holds. Fixed for a checkpoint's life.
BUCKETS = 512
TRACE = ("phone_number string, event_id string, ts_us long, " + ", ".join(f"{c} long" for c in COUNTERS)
         + ", countries long, produced_at double, arrived_at double")
LISTED = ("phone_number string, event_id string, ts_us long, total_calls long, probability double, written boolean, produced_at double,"
          " arrived_at double, done_at double")
columns_of = lambda schema: [c.split()[0] for c in schema.split(", ")]


def bucket() -> Column:
    return F.pmod(F.xxhash64("phone_number"), F.lit(BUCKETS)).cast("int")


def starts_of(numbers: pd.Series) -> np.ndarray:
    """True at the first row of each number of a sorted column."""
    codes = pd.factorize(numbers)[0]
    return np.concatenate([[True], codes[1:] != codes[:-1]])


class OrderedCounters(Held):
    """The counters of each number of a bucket after each of its events. A forgotten number sends one row with total_calls 0 behind its last event.

    With ``idle_s``, a number whose next event comes more than so many seconds of event time later starts anew, and its state is dropped when the watermark
    is past that time, an eighth of it later at most.
    """

    unique = ["phone_number", "event_id"]
    order = ["phone_number", "ts_us", "event_id"]

    def open_state(self, handle: StatefulProcessorHandle) -> None:
        self.numbers = handle.getMapState("numbers", "phone_number string", ", ".join(f"{c} long" for c in COUNTERS) + ", countries array<string>, newest_us long")

    def released(self, key, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        times, phones, countries = rows["ts_us"].to_numpy(), rows["phone_number"].to_numpy(), rows["country"].to_numpy()
        apart = None if self.idle_s is None else int(self.idle_s * 1e6)
        own = starts_of(rows["phone_number"])
        cut = own.copy()
        if apart is not None:
            cut[1:] |= np.diff(times) > apart
        starts, run = np.flatnonzero(cut), cut.cumsum() - 1
        base, seen, gone = np.zeros((len(starts), len(COUNTERS)), dtype=np.int64), [frozenset()] * len(starts), []
        for i, low in enumerate(starts):
            if not own[low]:
                gone.append((phones[low], int(times[low - 1])))
            elif (known := self.numbers.getValue((phones[low],))) is not None:
                *counts, held, newest = known
                if apart is not None and times[low] - newest > apart:
                    gone.append((phones[low], newest))
                else:
                    base[i], seen[i] = counts, frozenset(held)
        first = ~pd.DataFrame({"run": run, "country": countries}).duplicated().to_numpy()
        added: list[list] = [[] for _ in starts]
        for i in np.flatnonzero(first):
            if countries[i] in seen[run[i]]:
                first[i] = False
            else:
                added[run[i]].append(countries[i])
        # Running sums over all numbers, less those at the start of the run.
        total, places = rows[COUNTERS].to_numpy(dtype=np.int64).cumsum(axis=0), first.cumsum()
        before = lambda sums: np.concatenate([sums[:1] * 0, sums[starts[1:] - 1]])
        after = total + (base - before(total))[run]
        met = places + (np.array([len(x) for x in seen]) - before(places))[run]
        ends = np.append(starts[1:], len(rows)) - 1
        for i, end in enumerate(ends):
            if end + 1 == len(rows) or own[end + 1]:
                self.numbers.updateValue((phones[end],), (*after[end].tolist(), sorted({*seen[i], *added[i]}), int(times[end])))
        if apart is not None:
            self._wake(int(times.max()) + apart)
        yield from self.forgotten(gone)
        out = pd.DataFrame(after, columns=COUNTERS).assign(
            phone_number=phones, event_id=rows["event_id"], ts_us=times, countries=met, produced_at=rows["produced_at"], arrived_at=rows["arrived_at"])
        yield from sliced(out[columns_of(TRACE)])

    def _wake(self, at_us: int) -> None:
        """Set a timer, at one of eight times of an idle period, to look for numbers that are idle since."""
        self.handle.registerTimer((at_us // 1000 // self._step() + 1) * self._step())

    def _step(self) -> int:
        return max(1, int(self.idle_s * 1000) // 8)

    def idle(self, key, until: int, timer_ms: int) -> Iterator[pd.DataFrame]:
        if timer_ms % self._step():
            return
        gone = [(phone, state[-1]) for (phone,), state in self.numbers.iterator() if state[-1] + self.idle_s * 1e6 < until]
        for phone, _ in gone:
            self.numbers.removeKey((phone,))
        yield from self.forgotten(gone)

    def forgotten(self, gone: list[tuple[str, int]]) -> Iterator[pd.DataFrame]:
        if gone:
            yield pd.DataFrame([[phone, None, newest + 1, *[0] * len(COUNTERS), 0, 0.0, 0.0] for phone, newest in gone], columns=columns_of(TRACE))


def moves(p: np.ndarray, last: float, step: float) -> list[int]:
    """Places of ``p`` more than ``step`` from the value at the place before; the first is held against ``last``, NaN if there is none."""
    found, at, width = [], 0, 64
    while at < len(p):
        # Looks farther and farther ahead, so that the work grows with the rows and the places alone.
        far = np.flatnonzero(~(np.abs(p[at:at + width] - last) <= step))
        if len(far):
            at += int(far[0])
            found.append(at)
            last, at, width = p[at], at + 1, 64
        else:
            at, width = at + width, 2 * width
    return found


class WrittenMarks(StatefulProcessor):
    """Every event of a bucket, with ``written`` where it enters the blacklist: probable, seen often enough, and moved since its number's last entry."""

    def __init__(self, threshold: float, min_calls: int, step: float):
        self.threshold, self.min_calls, self.step = threshold, min_calls, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "phone_number string", "probability double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = ordered(pd.concat(list(rows), ignore_index=True), ["phone_number", "ts_us", "event_id"])
        p, calls, phones = held["probability"].to_numpy(dtype=float), held["total_calls"].to_numpy(), held["phone_number"].to_numpy()
        may, gone, written = (p >= self.threshold) & (calls >= self.min_calls), calls == 0, np.zeros(len(held), dtype=bool)
        starts = np.flatnonzero(starts_of(held["phone_number"]))
        ends = np.append(starts[1:], len(held))
        for i in np.flatnonzero(np.logical_or.reduceat(may | gone, starts)):  # the others leave their number's state alone
            low, high = starts[i], ends[i]
            known = self.last.getValue((phones[low],))
            last = before = np.nan if known is None else known[0]
            cuts = [low, *(low + np.flatnonzero(gone[low:high])).tolist(), high]
            for n, (left, right) in enumerate(zip(cuts, cuts[1:])):
                if n:  # forgotten: what follows is listed anew
                    last = np.nan
                places = left + np.flatnonzero(may[left:right])
                if new := moves(p[places], last, self.step):
                    written[places[new]], last = True, float(p[places[new[-1]]])
            if not np.isnan(last) and last != before:
                self.last.updateValue((phones[low],), (last,))
            elif np.isnan(last) and known is not None:
                self.last.removeKey((phones[low],))
        yield from sliced(held[~gone].assign(written=written[~gone], done_at=time.time())[columns_of(LISTED)])

    def close(self) -> None:
        pass


def event_trace(events: DataFrame, delay: str = "10 minutes", idle_s: float | None = None) -> DataFrame:
    """Every event with its number's counters after it, in order of (time, event_id), each event_id once.

    ``events`` needs the columns of call events and ``ts``. Events later than ``delay`` are dropped by the watermark; those without a time or id are left
    out; a null country is a country of its own. With ``idle_s``, a number without events for so long starts anew.
    """
    flags = events.filter("event_id is not null and phone_number is not null").select(
        "phone_number", "event_id", "ts", F.coalesce("caller_country", F.lit("")).alias("country"), F.coalesce("produced_at", F.lit(0.0)).alias("produced_at"),
        (F.unix_micros(F.current_timestamp()) / 1_000_000).alias("arrived_at"), *[c.alias(n) for n, c in event_counters().items()])
    return in_order(dated(flags.withColumn("bucket", bucket()), delay), "bucket", OrderedCounters(idle_s), TRACE)


def event_log(events: DataFrame, add_score: Callable[[DataFrame], DataFrame], threshold: float, min_calls: int = MIN_CALLS,
              step: float = WRITE_STEP, delay: str = "10 minutes", idle_s: float | None = None) -> DataFrame:
    """Every event with its probability and whether it is written to the blacklist. ``add_score`` adds ``probability``."""
    trace = event_trace(events, delay, idle_s).select(
        "phone_number", "event_id", "ts_us", "total_calls", "produced_at", "arrived_at", *[c.alias(n) for n, c in state_features().items()])
    scored = add_score(trace).select("phone_number", "event_id", "ts_us", "total_calls", F.round("probability", 4).alias("probability"),
                                     "produced_at", "arrived_at")
    return scored.withColumn("bucket", bucket()).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=WrittenMarks(threshold, min_calls, step), outputStructType=LISTED, outputMode="Append", timeMode="None")


def keep(stream: DataFrame, store: BlacklistStore, bounded: bool = True) -> StreamingQuery:
    """Write the entries and one row of latency sketches per micro-batch into ``store``.

    A batch writes folders of its own number, so a batch that is run again replaces what it had written.
    """

    def batch(rows: DataFrame, number: int) -> None:
        rows = rows.persist()
        entries = rows.filter("written").select(
            "phone_number", "probability", F.col("total_calls").alias("calls_observed"), "event_id", F.col("done_at").alias("blacklisted_at"), "produced_at", "ts_us")
        entries.write.mode("overwrite").parquet(store.delta(number))
        ms = lambda start: (F.col("done_at") - F.col(start)) * 1000
        end_to_end = F.when(F.col("produced_at") > 0, ms("produced_at"))
        sketches = rows.agg(
            F.count("*").alias("events"), F.count_if("written").alias("entries"), F.kll_sketch_agg_double(ms("arrived_at"), F.lit(SKETCH_K)).alias("processing"),
            F.kll_sketch_agg_double(end_to_end, F.lit(SKETCH_K)).alias("end_to_end"), F.count(end_to_end).alias("produced"))
        sketches.filter("events > 0").write.mode("overwrite").parquet(store.latency(number))
        rows.unpersist()

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", store.checkpoint())
    return (writer.trigger(availableNow=True) if bounded else writer).start()


def report(spark: SparkSession, store: BlacklistStore) -> DataFrame:
    """events, entries_written, listed_numbers, and p50, p95 and p99 of processing and end-to-end latency (ms) over all events.

    The events are counted by the batches themselves. Quantiles come from the merged sketches; end-to-end ones are null when no event carries its
    time of production.
    """
    seen = store.latencies()
    merged = seen.agg(F.coalesce(F.sum("events"), F.lit(0)).alias("events"), F.coalesce(F.sum("entries"), F.lit(0)).alias("entries_written"),
                      F.coalesce(F.sum("produced"), F.lit(0)).alias("produced"),
                      *[F.kll_merge_agg_double(c).alias(c) for c in ("processing", "end_to_end")])
    quantile = lambda c, q, n: F.when(F.col(n) > 0, F.kll_sketch_get_quantile_double(c, F.lit(q)))
    figures = [quantile(c, q, n).alias(f"{c}_{name}_ms") for c, n in (("processing", "events"), ("end_to_end", "produced"))
               for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))]
    listed = store.history().agg(F.count_distinct("phone_number")).scalar()
    return merged.select("events", "entries_written", listed.alias("listed_numbers"), *figures)
