"""Scans in blocks against plain loops: hot keys, ties of blocks, nulls, empty tables."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from uelumen.operators import analytics, scans, sequences, silver

RNG = random.Random(5)
ROWS = [(RNG.choice("hhhhhhab"), RNG.randrange(300) if RNG.random() > 0.02 else None, i, RNG.randrange(1000) if RNG.random() > 0.05 else None, RNG.random() < 0.6) for i in range(700)]
SCHEMA = "k string, at long, n long, v long, hit boolean"


def by_key(rows, order):
    for k, own in itertools.groupby(sorted(rows, key=lambda r: (r[0], *order(r))), key=lambda r: r[0]):
        yield k, list(own)


def first_nulls(r):
    return (r[1] is not None, r[1] or 0, r[2])


@pytest.mark.parametrize("size", [1, 7, 50, 100_000])
def test_prefix_maximum(spark, size):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {(r.k, r.n): r.seen for r in scans.seen_before(df, "v", ["at", "n"], [F.col("k")], scans.block_of("at", size), "seen").collect()}
    want = {}
    for k, own in by_key(ROWS, first_nulls):
        top = None
        for r in own:
            want[k, r[2]] = top
            top = r[3] if top is None else top if r[3] is None else max(top, r[3])
    assert got == want


@pytest.mark.parametrize("size", [1, 7, 50, 100_000])
def test_row_numbers(spark, size):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {(r.k, r.n): r.no for r in scans.numbered(df, ["k"], ["at", "n"], scans.block_of("at", size), "no").collect()}
    assert got == {(k, r[2]): i for k, own in by_key(ROWS, first_nulls) for i, r in enumerate(own)}


@pytest.mark.parametrize("size, fan", [(1, None), (7, None), (7, 3), (50, 2), (100_000, None)])
def test_runs_merge_in_any_grouping(spark, size, fan):
    rows = [r for r in ROWS if r[1] is not None]
    df = spark.createDataFrame(rows, SCHEMA)
    runs = scans.block_runs(df, "k", ["at", "n"], F.col("hit"), scans.block_of("at", size))
    if fan:
        runs = scans.merge_blocks(runs, "k", fan)
    got = {r.k: (r.n, r.prefix, r.suffix, r.best) for r in scans.merge_blocks(runs, "k").select("k", "runs.*").collect()}
    for k, own in by_key(rows, first_nulls):
        hits = [r[4] for r in own]
        ends = [len(list(itertools.takewhile(bool, x))) for x in (hits, hits[::-1])]
        assert got[k] == (len(hits), *ends, max((len(list(g)) for h, g in itertools.groupby(hits) if h), default=0))


def test_longest_runs_by_iso_time(spark):
    rows = [("u", f"2024-01-01T{h:02d}:59:59Z", h not in (3, 4, 9)) for h in range(12)] + [("v", "2024-01-01T00:00:00Z", None), ("w", None, True), ("w", "2024-01-01T00:00:00Z", True)]
    got = analytics.longest_runs(spark.createDataFrame(rows, "ue_key string, window_end_event_time string, is_anomaly boolean")).collect()
    assert sorted(map(tuple, got)) == [("u", 4), ("v", 0), ("w", 2)]


@pytest.mark.parametrize("length, stride, stretch", [(32, 8, 512), (32, 8, 4), (32, 8, 1), (5, 5, 2), (7, 3, 1), (1, 1, 1), (10, 1, 3)])
def test_windows_in_stretches(spark, length, stride, stretch):
    rows = [(k, at or 0, n) for k, at, n, _, _ in ROWS]
    df = spark.createDataFrame(rows, "k string, at long, n long")
    args = {"key": "k", "order": ("at", "n"), "length": length, "stride": stride}
    whole = sequences.windows(df, **args).select("k", "window_no", "events.n")
    dealt = sequences.windows(df, block=scans.block_of("at", 20), stretch=stretch, **args).select("k", "window_no", "events.n")
    found = sorted((r.k, r.window_no, r.n) for r in dealt.collect())
    assert found == sorted((r.k, r.window_no, r.n) for r in whole.collect())
    own = [n for k, at, n in sorted(rows) if k == "h"]
    assert [x for k, _, x in found if k == "h"] == [own[i : i + length] for i in range(0, len(own) - length + 1, stride)]


def test_late_events_by_blocks_of_offsets(spark):
    # equal to the greatest time less the tolerance is on time for the late route, too late for the reorder route
    rows = [("p", 0, 100_000), ("p", 70_000, 70_000), ("p", 140_000, 69_999), ("p", 140_001, 100_001), ("q", 140_002, 1)]
    df = spark.createDataFrame(rows, "k string, at long, ts long")
    assert [r.ts for r in silver.split_late(df, ts="ts", arrival=["at"], key=["k"])["late"].collect()] == [69_999]
    assert sorted(r.ts for r in sequences.split_too_late(df, key="k", ts="ts", arrival=["at"])["too_late"].collect()) == [69_999, 70_000]


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert scans.numbered(df, ["k"], ["at"], scans.block_of("at", 5), "no").count() == 0
    assert scans.seen_before(df, "v", ["at"], [F.col("k")], scans.block_of("at", 5), "seen").count() == 0
    assert analytics.longest_runs(df, ue="k", flag="hit", order=("at",)).count() == 0


def test_no_key_is_one_task(spark):
    """All rows are one subscriber's; numbering, maxima and windows are dealt by block."""
    df = spark.range(20_000).selectExpr("'u' AS k", "id * 1000 AS at", "id AS n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = sequences.windows(df, key="k", order=("at", "n"), block=scans.block_of("at", 600_000), stretch=16)
        tasks = made.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks == 4
