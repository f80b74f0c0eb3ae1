"""Late and unordered rows: a buffer per key that is released in order of time as the watermark passes.

Spark drops rows that are older than the watermark and calls a key's timer when the watermark has reached it. Between the two, rows wait in the key's
state, in parts as they came. So whatever the order and the batches in which rows arrive within the watermark's delay, a key sees
them once each and in order of (time, id).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: State with lists and timers needs this provider.
ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
#: Rows that are packed or handed to Spark at once.
SLICE_ROWS = 10_000


def packed(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(held: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(held).read_all().to_pandas()


def sliced(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for low in range(0, len(rows), SLICE_ROWS):
        yield rows.iloc[low:low + SLICE_ROWS]


def ordered(rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    """Rows in a stable order, nulls last."""
    keys = pa.table({c: pa.array(rows[c], from_pandas=True) for c in by})
    return rows.take(pc.sort_indices(keys, sort_keys=[(c, "ascending") for c in by]).to_numpy()).reset_index(drop=True)


class Held(StatefulProcessor):
    """Rows wait in the state of their group until the watermark passes them; subclasses say what becomes of the released rows.

    Rows need ``ts`` (a timestamp with a watermark), ``ts_us`` (the same in microseconds), and the columns ``unique`` and ``order``. Of rows that repeat
    ``unique`` one is kept, that with the smallest time. A group may be one key or many.
    """

    unique: str | list[str] = "event_id"
    order = ["ts_us", "event_id"]

    def __init__(self, idle_s: float | None = None):
        self.idle_s = idle_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # A list state would read all it holds at each append.
        self.pending = handle.getMapState("pending", "part long", "rows binary")
        self.parts = handle.getValueState("parts", "n long")
        self.done: dict[tuple, int] = {}
        self.open_state(handle)

    def open_state(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def released(self, key, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """What rows that are now complete and in order give."""
        raise NotImplementedError

    def idle(self, key, until: int, timer_ms: int) -> Iterator[pd.DataFrame]:
        """What is forgotten when the watermark has reached ``until`` (microseconds); only with ``idle_s``."""
        raise NotImplementedError

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = self._hold(pdf for pdf in rows if len(pdf))
        if first is not None:
            self.done.pop(tuple(key), None)
            self.handle.registerTimer(-(-first // 1000))
        return iter([])

    def _hold(self, parts: Iterator[pd.DataFrame]) -> int | None:
        """Put rows behind those that wait; their smallest time."""
        n, first = self.parts.get()[0] if self.parts.exists() else 0, None
        for pdf in parts:
            self.pending.updateValue((n,), (packed(pdf),))
            n, low = n + 1, int(pdf["ts_us"].min())
            first = low if first is None else min(first, low)
        self.parts.update((n,))
        return first

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        # Several batches may have set a timer; the first one that expires releases what all of them wait for.
        if self.done.get(tuple(key)) != until:
            self.done[tuple(key)] = until
            if self.pending.exists():
                yield from self._due(key, until)
        if self.idle_s is not None:
            yield from self.idle(key, until, expiredTimerInfo.getExpiryTimeInMs())

    def _due(self, key, until: int) -> Iterator[pd.DataFrame]:
        parts = sorted(part for part, in self.pending.keys())
        held = pd.concat([unpacked(self.pending.getValue((part,))[0]) for part in parts], ignore_index=True)
        held = ordered(held, self.order).drop_duplicates(self.unique, ignore_index=True)
        ready, rest = held[held["ts_us"] <= until], held[held["ts_us"] > until]
        if not len(ready):
            return
        self.pending.clear()
        self.parts.clear()
        if len(rest):
            self.handle.registerTimer(-(-self._hold(sliced(rest)) // 1000))
        yield from self.released(key, ready.reset_index(drop=True))

    def close(self) -> None:
        pass


class InOrder(Held):
    """Subclasses fold the released rows of a key, which is the group.

    With ``idle_s``, a key whose next row comes more than so many seconds of event time later starts anew, and its state is dropped when the
    watermark is past that time.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "ts_us long")
        super().init(handle)

    def fold(self, key, rows: pd.DataFrame) -> pd.DataFrame:
        """What the rows of ``key``, now complete and in order, give."""
        raise NotImplementedError

    def forget(self, key, newest_us: int) -> pd.DataFrame | None:
        """Clear the state of a key whose last row was at ``newest_us``; may give rows that say so."""
        raise NotImplementedError

    def idle(self, key, until: int, timer_ms: int) -> Iterator[pd.DataFrame]:
        if self.newest.exists() and self.newest.get()[0] + self.idle_s * 1e6 < until:
            yield from self._forgotten(key)

    def released(self, key, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        times = rows["ts_us"].to_numpy()
        if self.idle_s is None:
            yield self.fold(key, rows)
            return
        apart = int(self.idle_s * 1e6)
        cuts = [0, *(i + 1 for i, gap in enumerate(times[1:] - times[:-1]) if gap > apart), len(times)]
        for low, high in zip(cuts, cuts[1:]):
            if self.newest.exists() and times[low] - self.newest.get()[0] > apart:
                yield from self._forgotten(key)
            self.newest.update((int(times[high - 1]),))
            yield self.fold(key, rows.iloc[low:high].reset_index(drop=True))
        self.handle.registerTimer((int(times[-1]) + apart) // 1000 + 1)

    def _forgotten(self, key) -> Iterator[pd.DataFrame]:
        newest = self.newest.get()[0]
        self.newest.clear()
        gone = self.forget(key, newest)
        if gone is not None:
            yield gone


def dated(df: DataFrame, delay: str) -> DataFrame:
    """``df`` (with ``ts``) under a watermark and with ts_us; rows without a time cannot be ordered and are left out."""
    return df.filter("ts is not null").withColumn("ts_us", F.unix_micros("ts")).withWatermark("ts", delay)


def in_order(df: DataFrame, key: str, processor: Held, schema: str) -> DataFrame:
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")
