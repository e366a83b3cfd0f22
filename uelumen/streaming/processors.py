"""Stateful operators of the streaming plans, on ``transformWithStateInPandas`` with the RocksDB state store.

All three run in processing-time mode: in event-time mode Spark drops rows behind the watermark before they reach the
operator, and here late rows are an output.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

TTL_MS = 24 * 3600 * 1000


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class FirstOnly(StatefulProcessor):
    """Passes the first row of each key, by ``order`` within a batch, and drops the rest until the state expires."""

    def __init__(self, ttl_ms: int = TTL_MS, order: str | None = None):
        self.ttl_ms, self.order = ttl_ms, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "flag boolean", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            return
        frames = [f for f in rows if len(f)]
        if frames:
            first = pd.concat(frames) if len(frames) > 1 else frames[0]
            self.seen.update((True,))
            yield (first.sort_values(self.order, kind="stable") if self.order else first).iloc[:1]

    def close(self) -> None:
        pass


class LateRouter(StatefulProcessor):
    """Adds ``late``: behind the greatest time its key has shown before, less the tolerance. Equal is on time.

    A shuffle hands rows on in any order, so those of a batch are sorted by ``order`` first.
    """

    def __init__(self, ts: str, tolerance_ms: int = 30_000, order: str | None = None):
        self.ts, self.tolerance_ms, self.order = ts, tolerance_ms, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getValueState("top", "ms long", ttlDurationMs=TTL_MS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        top = self.top.get()[0] if self.top.exists() else None
        frames = [f for f in rows if len(f)]
        if self.order and frames:
            frames = [(pd.concat(frames) if len(frames) > 1 else frames[0]).sort_values(self.order, kind="stable")]
        for frame in frames:
            late = []
            for ms in frame[self.ts].tolist():
                late.append(top is not None and ms < top - self.tolerance_ms)
                top = ms if top is None else max(top, ms)
            yield frame.assign(late=late)
        if top is not None:
            self.top.update((int(top),))

    def close(self) -> None:
        pass


class SequenceProcessor(StatefulProcessor):
    """Reorders the events of a subscriber and cuts count windows.

    An event at or before what was finalised is too late. Others wait until the greatest time seen is ``tolerance_ms``
    ahead; then they join the buffer in order, from which windows of ``length`` are cut every ``stride``. If nothing comes for
    ``idle_ms`` all that wait are released. No partial window is ever emitted.

    State. Events wait in a map by (bucket of time, number in the bucket); a bucket is a 256th of the tolerance, so there are about 256 at most, and their sizes
    are a short list. A new event is one put; a released one is one get and one remove; buckets that can't be due yet aren't read, whatever waits in them. An event that comes and
    is released in the same call never touches the map. The buffer, less than ``length`` rows, is read and put at most once a call.

    Output rows: ``route`` (window or too_late), ``window_no`` of the key, ``position`` in the window, and the event's columns.
    """

    def __init__(self, columns: list[str], state: str, ts: str = "event_time_epoch_ms", order: str = "source_order_key", length: int = 32, stride: int = 8, tolerance_ms: int = 30_000, idle_ms: int = 60_000, ttl_ms: int = TTL_MS, arrival: str | None = None):
        if length <= 0 or not 1 <= stride <= length or tolerance_ms < 0 or idle_ms <= 0 or ttl_ms <= 0:
            raise ValueError("length, stride, tolerance, idle time or TTL out of range")
        self.columns, self.state, self.ts, self.order = columns, state, ts, order
        self.length, self.stride, self.tolerance_ms, self.idle_ms, self.ttl_ms = length, stride, tolerance_ms, idle_ms, ttl_ms
        self.ts_at, self.order_at, self.width = columns.index(ts), columns.index(order), max(1, tolerance_ms // 256)
        self.arrival = arrival  # within a batch rows are taken in this order, whatever that in which a shuffle hands them on

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket long, number long", self.state, ttlDurationMs=self.ttl_ms)
        self.buckets = handle.getListState("buckets", "bucket long, size long", ttlDurationMs=self.ttl_ms)
        self.buffer = handle.getListState("buffer", self.state, ttlDurationMs=self.ttl_ms)
        self.marks = handle.getValueState("marks", "top long, finalised long, idle_timer long, windows long", ttlDurationMs=self.ttl_ms)

    def _begin(self) -> None:
        """What a call knows: the marks, the sizes of the stored buckets, and in ``near`` the events at hand, by time."""
        self.top, self.finalised, self.timer, self.windows = self.marks.get() if self.marks.exists() else (None, None, None, 0)
        self.sizes = {int(b): int(n) for b, n in self.buckets.get()} if self.buckets.exists() else {}
        self.stored = sorted(self.sizes)
        self.near: list[tuple] = []
        self.entries, self.held, self.changed = 0, None, False

    def _wait(self, row: tuple) -> None:
        self.entries += 1  # rows of equal time and key are not compared
        heappush(self.near, (row[self.ts_at], row[self.order_at], self.entries, row))

    def _release(self, through: int | None) -> list[tuple]:
        """Rows out as the events up to a time (all: None) join the buffer."""
        while self.stored and (through is None or self.stored[0] <= through // self.width):
            bucket = self.stored.pop(0)
            for number in range(self.sizes.pop(bucket)):
                at = (bucket, number)
                row = self.waiting.getValue(at)
                if row is not None:  # it hasn't outlived its time
                    self._wait(tuple(row))
                    self.waiting.removeKey(at)
            self.changed = True
        out: list[tuple] = []
        while self.near and (through is None or self.near[0][0] <= through):
            if self.held is None:
                self.held = [tuple(r) for r in self.buffer.get()] if self.buffer.exists() else []
            self.held.append(heappop(self.near)[-1])
            if len(self.held) == self.length:
                out += [("window", self.windows, i, *r) for i, r in enumerate(self.held)]
                self.windows += 1
                self.held = self.held[self.stride :]
        return out

    def _end(self) -> None:
        for ms, _, _, row in self.near:
            bucket = ms // self.width
            number = self.sizes.get(bucket, 0)
            self.waiting.updateValue((bucket, number), row)
            self.sizes[bucket] = number + 1
            self.changed = True
        if self.changed:
            self.buckets.put(sorted(self.sizes.items())) if self.sizes else self.buckets.clear()
        if self.held is not None:
            self.buffer.put(self.held) if self.held else self.buffer.clear()
        self.marks.update((int(self.top), int(self.finalised), self.timer, int(self.windows)))

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["route", "window_no", "position", *self.columns])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self._begin()
        out: list[tuple] = []
        accepted = False
        frames = [f for f in rows if len(f)]
        if self.arrival and frames:
            frames = [(pd.concat(frames) if len(frames) > 1 else frames[0]).sort_values(self.arrival, kind="stable")]
        for frame in frames:
            for row in frame[self.columns].itertuples(index=False, name=None):
                row = tuple(None if v is pd.NaT or v is None or v != v else v for v in row)
                ms = row[self.ts_at]
                if self.finalised is not None and ms <= self.finalised:
                    out.append(("too_late", None, None, *row))
                    continue
                accepted = True
                self._wait(row)
                self.top = ms if self.top is None else max(self.top, ms)
                safe = self.top - self.tolerance_ms
                out += self._release(safe)
                self.finalised = safe if self.finalised is None else max(self.finalised, safe)
        if accepted:
            if self.timer is not None:
                self.handle.deleteTimer(self.timer)
            self.timer = int(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
            self.handle.registerTimer(self.timer)
            self._end()
        if out:
            yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._begin()
        if self.timer is None or expiredTimerInfo.getExpiryTimeInMs() != self.timer:
            return
        out = self._release(None)
        self.finalised, self.timer = max(self.finalised, self.top), None
        self._end()
        if out:
            yield self._frame(out)

    def close(self) -> None:
        pass


class LatestOnly(StatefulProcessor):
    """One shard of a buffer of the newest ids: the last arrival of each id, and of these the newest ``keep``.

    A repeated id moves to the end of the line; beyond ``keep`` the oldest leaves. State: a row for each id, and its place in the line; what a row costs doesn't depend on how many are held.
    The buffer as a whole is the newest ``keep`` of all shards, since none of these can have left its shard.

    Output rows: ``change`` (put or evicted), ``place`` (rising in a shard), and the row's columns.
    """

    def __init__(self, columns: list[str], state: str, ident: str, arrival: str, keep: int):
        self.columns, self.state, self.ident, self.arrival, self.keep = columns, state, ident, arrival, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getMapState("rows", "id string", f"place long, {self.state}")
        self.line = handle.getMapState("line", "place long", "id string")
        self.marks = handle.getValueState("marks", "first long, next long, held long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, after, held = self.marks.get() if self.marks.exists() else (0, 0, 0)
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        frame = (pd.concat(frames) if len(frames) > 1 else frames[0]).sort_values(self.arrival, kind="stable")
        frame = frame.drop_duplicates(self.ident, keep="last")  # what a batch itself replaces was never seen
        out = []
        for row in frame[self.columns].astype(object).itertuples(index=False, name=None):
            row = tuple(None if v is pd.NaT or v is None or v != v else v for v in row)
            ident = (row[self.columns.index(self.ident)],)
            if self.rows.containsKey(ident):
                self.line.removeKey((self.rows.getValue(ident)[0],))
                held -= 1
            self.rows.updateValue(ident, (after, *row))
            self.line.updateValue((after,), ident)
            out.append(("put", after, *row))
            after, held = after + 1, held + 1
            while held > self.keep:
                oldest = (first,)
                if self.line.containsKey(oldest):
                    gone = tuple(self.line.getValue(oldest))
                    out.append(("evicted", *self.rows.getValue(gone)))
                    self.rows.removeKey(gone)
                    self.line.removeKey(oldest)
                    held -= 1
                first += 1
        self.marks.update((int(first), int(after), int(held)))
        yield pd.DataFrame(out, columns=["change", "place", *self.columns])

    def close(self) -> None:
        pass


def latest_stream(df: DataFrame, *, ident: str, arrival: str, keep: int, shards: int = 16) -> DataFrame:
    """Changes of the buffer of the newest ``keep`` ids, kept in shards by id."""
    state = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    sharded = df.withColumn("ul_shard", F.pmod(F.xxhash64(ident), F.lit(shards)))
    processor = LatestOnly(df.columns, state, ident, arrival, keep)
    return sharded.groupBy("ul_shard").transformWithStateInPandas(statefulProcessor=processor, outputStructType=f"change string, place long, {state}", outputMode="Append", timeMode="None")


def sequence_stream(events: DataFrame, *, key: str = "ue_key", **options) -> DataFrame:
    """The sequence operator on a stream of events."""
    state = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema)
    processor = SequenceProcessor(events.columns, state, **options)
    schema = f"route string, window_no long, position long, {state}"
    return events.groupBy(key).transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="ProcessingTime")


def dedup_stream(df: DataFrame, keys: list[str], ttl_ms: int = TTL_MS, order: str | None = None) -> DataFrame:
    return df.groupBy(*keys).transformWithStateInPandas(statefulProcessor=FirstOnly(ttl_ms, order), outputStructType=df.schema, outputMode="Append", timeMode="ProcessingTime")


def late_stream(df: DataFrame, key: str, ts: str, tolerance_ms: int = 30_000, order: str | None = None) -> DataFrame:
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) + ", late boolean"
    return df.groupBy(key).transformWithStateInPandas(statefulProcessor=LateRouter(ts, tolerance_ms, order), outputStructType=schema, outputMode="Append", timeMode="ProcessingTime")
