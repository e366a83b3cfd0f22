"""State of the streaming operators: operations a row, idle flush, expiry, schema, and the buffer of the newest ids."""

import collections
import itertools
import json
import random
import time

import pandas as pd
import pytest

from uelumen.contract import ContractError
from uelumen.schemas import TOPICS
from uelumen.streaming import checkpoints, jobs, processors, transport


class Held:
    """State variables in memory that count what is asked of them."""

    def __init__(self):
        self.calls, self.timers, self.vars = collections.Counter(), set(), {}

    def _var(self, name, kind):
        return self.vars.setdefault(name, kind(self, name))

    def getValueState(self, name, schema, ttlDurationMs=None):
        return self._var(name, Value)

    def getListState(self, name, schema, ttlDurationMs=None):
        return self._var(name, Several)

    def getMapState(self, name, keys, schema, ttlDurationMs=None):
        return self._var(name, Mapped)

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Value:
    def __init__(self, held, name):
        self.calls, self.name, self.value = held.calls, name, None

    def exists(self):
        return self.value is not None

    def get(self):
        self.calls[self.name, "get"] += 1
        return self.value

    def update(self, value):
        self.calls[self.name, "update"] += 1
        self.value = value

    put = update

    def clear(self):
        self.value = None


class Several(Value):
    def put(self, rows):
        self.calls[self.name, "put"] += 1
        self.value = list(rows)

    def get(self):
        self.calls[self.name, "get"] += 1
        return iter(self.value or [])


class Mapped:
    def __init__(self, held, name):
        self.calls, self.name, self.rows = held.calls, name, {}

    def getValue(self, key):
        self.calls[self.name, "get"] += 1
        return self.rows.get(tuple(key))

    def updateValue(self, key, value):
        self.calls[self.name, "put"] += 1
        self.rows[tuple(key)] = tuple(value)

    def containsKey(self, key):
        return tuple(key) in self.rows

    def removeKey(self, key):
        self.calls[self.name, "remove"] += 1
        del self.rows[tuple(key)]


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentProcessingTimeInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentProcessingTimeInMs


COLUMNS = ["ue_key", "event_time_epoch_ms", "source_order_key"]


def processor(**options):
    made, held = processors.SequenceProcessor(COLUMNS, "", **options), Held()
    made.init(held)
    return made, held


def feed(made, rows, now=0):
    frames = made.handleInputRows(("u",), iter([pd.DataFrame([("u", *r) for r in rows], columns=COLUMNS)]), Clock(now))
    return [tuple(r) for f in frames for r in f.itertuples(index=False)]


def plain(batches, length, stride, tolerance):
    """The rule, row by row: what comes out."""
    top = done = None
    pending, buffer, windows, out = [], [], 0, []
    for row in itertools.chain(*batches):
        if done is not None and row[0] <= done:
            out.append(("too_late", None, row))
            continue
        pending.append(row)
        top = row[0] if top is None else max(top, row[0])
        due = sorted(r for r in pending if r[0] <= top - tolerance)
        pending = [r for r in pending if r[0] > top - tolerance]
        for r in due:
            buffer.append(r)
            if len(buffer) == length:
                out.append(("window", windows, tuple(buffer)))
                windows, buffer = windows + 1, buffer[stride:]
        done = top - tolerance if done is None else max(done, top - tolerance)
    return out, sorted(pending), buffer


@pytest.mark.parametrize("seed, length, stride, tolerance", [(1, 32, 8, 30_000), (2, 5, 5, 700), (3, 4, 1, 0), (4, 7, 3, 90)])
def test_reorder_and_windows_by_single_operations(seed, length, stride, tolerance):
    rng = random.Random(seed)
    rows = [(max(-500, i * 100 + rng.randrange(-tolerance, tolerance // 2 + 1)), f"{i:05d}") for i in range(600)]
    batches = []
    while rows:
        n = rng.choice([1, 1, 2, 17, 60])
        batches.append(rows[:n])
        rows = rows[n:]
    made, held = processor(length=length, stride=stride, tolerance_ms=tolerance)
    got = []
    for batch in batches:
        out = feed(made, batch)
        got += [("too_late", None, (r[4], r[5])) for r in out if r[0] == "too_late"]
        for no, own in itertools.groupby((r for r in out if r[0] == "window"), key=lambda r: r[1]):
            got.append(("window", no, tuple((r[4], r[5]) for r in own)))
    want, pending, buffer = plain(batches, length, stride, tolerance)
    kinds = lambda rows, kind: [r for r in rows if r[0] == kind]
    assert kinds(got, "window") == kinds(want, "window") and kinds(got, "too_late") == kinds(want, "too_late")
    assert sorted(r[1:] for r in held.vars["waiting"].rows.values()) == pending
    assert [r[1:] for r in held.vars["buffer"].value or []] == buffer
    assert dict(held.vars["buckets"].value or {}) == collections.Counter(k[0] for k in held.vars["waiting"].rows)


def test_operations_a_row_do_not_grow_with_what_waits():
    cost = {}
    for waiting in (100, 10_000):
        made, held = processor()
        feed(made, [(int(i * 29_000 / waiting), f"{i:06d}") for i in range(waiting)])
        assert len(held.vars["waiting"].rows) == waiting
        held.calls.clear()
        for i in range(50):  # each is due at once no more than the first bucket
            feed(made, [(29_001 + i, f"x{i}")])
        cost[waiting] = sum(n for (name, what), n in held.calls.items() if name == "waiting")
    assert cost[100] == cost[10_000] == 50


def test_released_rows_read_and_put_the_buffer_once_a_call():
    made, held = processor()
    feed(made, [(i * 10, f"{i:05d}") for i in range(3000)])
    held.calls.clear()
    out = feed(made, [(100_000, "z")])
    assert sum(r[0] == "window" for r in out) // 32 == (3000 - 32) // 8 + 1
    assert held.calls["buffer", "get"] <= 1 and held.calls["buffer", "put"] == 1
    assert held.calls["waiting", "get"] == held.calls["waiting", "remove"] == 3000


def test_idle_timer_releases_all_and_stale_timers_do_nothing():
    made, held = processor(idle_ms=60_000)
    assert feed(made, [(i * 500, f"{i:02d}") for i in range(40)], now=1_000) == []  # all within the tolerance
    feed(made, [(19_900, "98")], now=5_000)  # armed anew
    assert held.timers == {65_000}
    assert list(made.handleExpiredTimer(("u",), Clock(61_000), Clock(61_000))) == []
    (out,) = made.handleExpiredTimer(("u",), Clock(65_000), Clock(65_000))
    assert out["window_no"].tolist() == [0] * 32 + [1] * 32  # 41 events; 7 of the second and third stride stay, no partial window
    assert not held.vars["waiting"].rows and len(held.vars["buffer"].value) == 41 - 16
    assert [r[0] for r in feed(made, [(19_900, "97"), (19_901, "99")])] == ["too_late"]  # finalised through the greatest time


def run_all(query):
    assert query.awaitTermination(120)
    assert query.exception() is None


def test_idle_flush_in_a_stream(spark, tmp_path):
    """40 events 500 ms apart: none is older than the tolerance, so only the timer can release them."""
    schema = "ue_key string, event_time_epoch_ms long, source_order_key string"
    spark.createDataFrame([("u", i * 500, f"{i:02d}") for i in range(40)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    processors.use_rocksdb(spark)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    made = processors.sequence_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), idle_ms=6_000)
    query = made.writeStream.format("memory").queryName("flushed").option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()
    try:
        end, early = time.time() + 90, None
        while time.time() < end and query.isActive:
            done = [p for p in query.recentProgress if p.numInputRows]
            if done and early is None:
                early = spark.table("flushed").count()
            if spark.table("flushed").count():
                break
            time.sleep(0.5)
    finally:
        query.stop()
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    rows = spark.table("flushed").orderBy("window_no", "position").collect()
    assert early == 0
    assert [r.source_order_key for r in rows] == [f"{i:02d}" for w in (0, 8) for i in range(w, w + 32)]
    # what the checkpoint holds: nothing waits, 24 events in the buffer
    cp = str(tmp_path / "cp")
    assert checkpoints.state(spark, cp, "waiting").count() == 0
    assert checkpoints.state(spark, cp, "marks").count() == 1
    declared = {"marks": "top long, finalised long, idle_timer long, windows long"}
    checkpoints.check(spark, cp, declared)
    with pytest.raises(ContractError, match="not"):
        checkpoints.check(spark, cp, {"marks": "top long, finalised string, idle_timer long, windows long"})
    with pytest.raises(ContractError, match="no state"):
        checkpoints.check(spark, cp, {"pending": "top long"})


def test_expired_state_is_forgotten(spark, tmp_path):
    """A duplicate is dropped until its key's state has outlived its time; after that it counts as new."""
    processors.use_rocksdb(spark)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    cp, seen = str(tmp_path / "cp"), []
    try:
        for n, wait in ((1, 0), (2, 0), (3, 21)):
            time.sleep(wait)
            spark.createDataFrame([("a", n)], "k string, n long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = processors.dedup_stream(spark.readStream.schema("k string, n long").parquet(str(tmp_path / "in")), ["k"], ttl_ms=20_000)
            run_all(stream.writeStream.foreachBatch(lambda b, i: seen.extend(r.n for r in b.collect())).option("checkpointLocation", cp).trigger(availableNow=True).start())
            if n == 1:
                rows = checkpoints.state(spark, cp, "seen")
                left = rows.select(checkpoints.expiry(rows)).first()[0] - time.time() * 1000
                assert 0 < left <= 20_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert seen == [1, 3]


def test_buffer_shard_evicts_the_oldest():
    made, held = processors.LatestOnly(["id", "arrival", "v"], "", "id", "arrival", 3), Held()
    made.init(held)
    out = []
    for batch in ([("a", 1, 1), ("b", 2, 1)], [("a", 3, 2)], [("c", 4, 1), ("d", 5, 1)], [("d", 6, 2), ("d", 7, 3), ("e", 8, 1)], [("b", 9, 2)]):
        (frame,) = made.handleInputRows((0,), iter([pd.DataFrame(batch, columns=["id", "arrival", "v"])]), None)
        out.append([(r.change, r.id, r.v) for r in frame.itertuples()])
    assert out == [
        [("put", "a", 1), ("put", "b", 1)], [("put", "a", 2)], [("put", "c", 1), ("put", "d", 1), ("evicted", "b", 1)],
        [("put", "d", 3), ("put", "e", 1), ("evicted", "a", 2)], [("put", "b", 2), ("evicted", "c", 1)],
    ]
    assert {k[0] for k in held.vars["rows"].rows} == {"d", "e", "b"} and len(held.vars["line"].rows) == 3


def test_prediction_buffer_is_rebuilt_from_earliest(spark, tmp_path):
    """Batch by batch, or all at once in a new query: the same newest ids; and the same as the batch operator."""
    topics = transport.FileTransport(f"file://{tmp_path}/topics", partitions=2)
    rng, batches = random.Random(4), []
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for batch in range(4):
            rows = [(f"p{rng.randrange(60)}" if rng.random() > 0.05 else "", batch * 100 + i) for i in range(25)]
            made = spark.createDataFrame(rows, "prediction_id string, n long")
            keyed = made.selectExpr(f"'{TOPICS['predictions'][0]}' AS topic", "cast(n AS string) AS key", "to_json(struct(*)) AS value", "n AS ul_order")
            topics.commit([(keyed, ["ul_order"])], batch, "scoring")
            batches += rows
            job = jobs.Settings(checkpoints=f"file://{tmp_path}/cp-a", once=True)
            run_all(jobs.buffer_job(spark, topics, job, f"file://{tmp_path}/a", keep=20, shards=3))
        run_all(jobs.buffer_job(spark, topics, jobs.Settings(checkpoints=f"file://{tmp_path}/cp-b", once=True), f"file://{tmp_path}/b", keep=20, shards=3))
        one, other = (sorted(map(tuple, jobs.read_buffer(spark, f"file://{tmp_path}/{x}").collect())) for x in "ab")
        assert one == other and len(one) == 20
        raw = topics.read(spark, TOPICS["predictions"][0]).collect()
        newest = {}
        for r in sorted(raw, key=lambda r: (r.kafka_timestamp, r.partition, r.offset)):
            ident = json.loads(r.value)["prediction_id"] or f"{r.partition}:{r.offset}"
            newest.pop(ident, None)
            newest[ident] = r.value
        assert sorted((i, v) for i, _, v in one) == sorted(list(newest.items())[-20:])
        assert jobs.read_buffer(spark, f"file://{tmp_path}/none").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
