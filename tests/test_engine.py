"""Boundary values of the scalar rules, and the stateful operators against a plain simulation."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from uelumen import contract
from uelumen.functions import text, times
from uelumen.operators import analytics, bronze, sequences, silver
from uelumen.sources import ingest


def values(spark, rule, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]


def test_times(spark):
    """One case for each rule: milliseconds, local times with 0 to 9 digits, offsets either side of midnight, what is no time."""
    given = {
        "0951782399999": "2000-02-28T23:59:59.999Z",
        "1000000000000": "2001-09-09T01:46:40Z",
        "2031-12-31 23:59:59": "2031-12-31T16:59:59Z",
        "2032-02-29 03:00:00.5": "2032-02-28T20:00:00.500Z",
        "2025-01-01 07:00:00.000001": "2025-01-01T00:00:00.000001Z",
        "2025-01-01 07:00:00.100000000": "2025-01-01T00:00:00.100Z",
        "2025-06-15T00:30:00-02:45": "2025-06-15T03:15:00Z",
        "2025-06-15T23:10z": "2025-06-15T23:10:00Z",
        "\t2025-06-15T12:00:00.25+00:00\n": "2025-06-15T12:00:00.250Z",
    }
    assert values(spark, times.normalise, list(given)) == list(given.values())
    bad = [None, "", "\x00\x1f", "12345678901234", "99999999999", "2025-00-10 01:00:00", "2025-04-31 01:00:00", "2025-04-30 24:00:00", "2025-04-30 01:60:00", "2025-04-30", "2025-04-30 01:00:00.1234567890", "30.04.2025 01:00", "2025-04-30T01:00:00", "2025-04-30T01:00:00+19:00", "later", "1000000000O00"]
    assert values(spark, times.normalise, bad) == [None] * len(bad)
    # a local hour that is skipped in spring and one that comes twice in autumn
    berlin = lambda c: times.normalise(c, "Europe/Berlin")
    assert values(spark, berlin, ["2025-03-30 02:00:00", "2025-03-30 03:00:00", "2025-10-26 02:59:59", "2025-10-26 03:00:00"]) == [None, "2025-03-30T01:00:00Z", None, "2025-10-26T02:00:00Z"]
    assert values(spark, times.clock, ["2025-01-01T17:30:00Z", "2025-01-01T16:59:59.999Z", "noon"]) == ["00:30:00", "23:59:59", "noon"]


def test_numbers(spark):
    top, beyond = str(2**63 - 1), str(2**63)
    cases = {"": (None, False), "\n \r": (None, False), "7": (7, False), "+0": (0, False), "  0042\t": (42, False), top: (2**63 - 1, False), beyond: (None, True), "-7": (None, True), "7.0": (None, True), "1e3": (None, True), "0x1F": (None, True), "7 7": (None, True), "+": (None, True)}
    assert values(spark, text.nullable_number, list(cases)) == [v for v, _ in cases.values()]
    assert values(spark, text.number_fault, list(cases)) == [f for _, f in cases.values()]
    assert values(spark, lambda c: text.nullable_number(c, "int"), [str(2**31 - 1), str(2**31)]) == [2**31 - 1, None]


def test_identity_rules(spark):
    digits = lambda n: "7" * n
    assert values(spark, text.imsi, [digits(4), digits(5), f"\t{digits(15)} ", digits(16), "12345x", "12 345", None]) == [None, digits(5), digits(15), None, None, None, None]
    assert values(spark, text.msisdn, ["(+49) 170-55 555", "0049/170", digits(16), "+-()"]) == ["4917055555", None, None, None]
    assert values(spark, text.mtmsi, ["0Xfe", " 00ff ", "123456789ABC", digits(10), digits(11), "ghij", "0x"]) == ["FE", "00FF", None, digits(10), None, None, None]
    assert values(spark, text.event_name, ["__Bearer  Modify!!", "X.25/Setup", "\x01", "-_-", "9"]) == ["bearer_modify", "x_25_setup", None, None, "9"]
    assert values(spark, text.event_outcome, [" ABORT\n", "Success", "succes", "\t", None]) == ["abort", "success", None, "", None]
    assert values(spark, text.strip, ["\x00 a b\x1f\x20", "\u00a0a"]) == ["a b", "\u00a0a"]


def test_contract():
    assert contract.require_exact(contract.Contract()).length == 32
    assert list(contract.Contract().categorical["event_code"].values()) == list(range(1, 11))
    with pytest.raises(contract.ContractError):
        contract.require_exact(contract.Contract(stride=4))
    for bad in ({}, {"reset": 3, "\tRESET": 4}, {"up": 0, "down": 0}, {"up": -5}, {None: 2}, {"up": True}, {"up": "1"}):
        with pytest.raises(contract.ContractError):
            contract.check_vocabulary("v", bad)


def test_lines(spark, tmp_path):
    (tmp_path / "b.log").write_bytes(b"x;1\r\n\ny\n")
    (tmp_path / "a.log").write_bytes(b"only")
    (tmp_path / "empty.log").write_bytes(b"")
    (tmp_path / "sub").mkdir()
    got = [tuple(r) for r in ingest.envelopes(ingest.read_lines(spark, f"file://{tmp_path}")).orderBy("source_file", "source_line").collect()]
    assert [g[2:] for g in got] == [("a.log", 1, "only"), ("b.log", 1, "x;1"), ("b.log", 2, ""), ("b.log", 3, "y")]
    assert got[0][1] == hashlib.sha256(b"a.log:1:only").hexdigest()
    with pytest.raises(ValueError):
        ingest.read_lines(spark, f"file://{tmp_path}/sub")


def test_bronze_faults(spark):
    rows = [("t", 0, i, 0, v) for i, v in enumerate([None, "null", "[1]", "", '{"schema_version":"raw-envelope-v1","raw_record_id":"a","source_file":"f","source_line":1,"raw_payload":null}'])]
    out = bronze.bronze(spark.createDataFrame(rows, "topic string, `partition` int, `offset` long, kafka_timestamp long, value string"))
    codes = {r.offset: r.error_code for r in out["dlq"].select("source.offset", "error_code").collect()}
    assert codes == {0: "NULL_KAFKA_VALUE", 1: "INVALID_ENVELOPE_SCHEMA", 2: "INVALID_ENVELOPE_JSON", 3: "INVALID_ENVELOPE_JSON", 4: "EMPTY_RAW_PAYLOAD"}
    assert out["bronze"].count() == 0


def simulate(events, tolerance=30_000, length=32, stride=8):
    """(too late, windows) of (arrival, key, ts, order) tuples with a flush at the end."""
    late, out, state = [], [], {}
    for _, key, ts, order in sorted(events):
        s = state.setdefault(key, {"pending": [], "buffer": [], "top": None, "done": None})
        if s["done"] is not None and ts <= s["done"]:
            late.append(order)
            continue
        s["pending"].append((ts, order))
        s["top"] = ts if s["top"] is None else max(s["top"], ts)
        s["done"] = max(s["done"] if s["done"] is not None else -(10**18), s["top"] - tolerance)
    late_set = set(late)
    for key in state:
        rows = sorted((ts, o) for _, k, ts, o in events if k == key and o not in late_set)
        for i in range(0, len(rows) - length + 1, stride):
            out.append((key, [o for _, o in rows[i : i + length]]))
    return sorted(late), sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_sequences(spark, seed):
    rng = random.Random(seed)
    events = [(i, rng.choice("ab"), i * 1000 + rng.randint(0, 60_000), f"{i:05d}") for i in range(200)]
    df = spark.createDataFrame(events, "arrival int, ue_key string, event_time_epoch_ms long, source_order_key string")
    split = sequences.split_too_late(df, arrival=["arrival"])
    late, made = simulate(events)
    assert sorted(r.source_order_key for r in split["too_late"].collect()) == late
    got = sequences.windows(split["accepted"]).select("ue_key", F.transform("events", lambda e: e["source_order_key"]).alias("o")).collect()
    assert sorted((r.ue_key, list(r.o)) for r in got) == made


@pytest.mark.parametrize("n, expected", [(31, 0), (32, 1), (40, 2)])
def test_window_counts(spark, n, expected):
    df = spark.createDataFrame([("u", i * 1000, f"{i:03d}") for i in range(n)], "ue_key string, event_time_epoch_ms long, source_order_key string")
    assert sequences.windows(df).count() == expected


def test_first_by_coordinates(spark):
    source = "struct<topic:string,partition:int,offset:bigint>"
    rows = [("c", ("t", 0, 5)), ("b", ("t", 0, 5)), ("a", ("u", 0, 5)), ("d", ("t", 1, 5))]
    df = spark.createDataFrame(rows, f"raw_record_id string, source {source}").repartition(3)
    assert sorted(r.raw_record_id for r in silver.first_by_coordinates(df).collect()) == ["a", "b", "d"]


def test_windows_of_other_shapes(spark):
    df = spark.createDataFrame([("u", i, f"{i:03d}") for i in range(23)] + [("v", i, "x") for i in range(4)], "ue_key string, event_time_epoch_ms long, source_order_key string")
    for length, stride in ((5, 2), (4, 4), (7, 3), (1, 1), (23, 5), (24, 1)):
        got = sequences.windows(df, length=length, stride=stride).filter("ue_key = 'u'").orderBy("window_no").collect()
        assert [[e.event_time_epoch_ms for e in r.events] for r in got] == [list(range(i, i + length)) for i in range(0, 23 - length + 1, stride)]
    made = sequences.windows(df.withColumn("imsi", F.col("ue_key")), length=2, stride=2)
    shuffled = made.withColumn("events", F.reverse("events"))
    assert made.filter(~sequences.ordered(F.col("events"))).count() == 0 and shuffled.filter(sequences.ordered(F.col("events"))).filter("ue_key = 'u'").count() == 0


def test_contract_faults(spark):
    event = "struct<event_id:string>"
    ddl = f"schema_version string, feature_version string, sequence_length int, stride int, sample_id string, ue_key string, model_input struct<x_cat:array<array<bigint>>,x_num:array<array<float>>>, evidence struct<events:array<{event}>>"
    sound = {"schema_version": "gold-sequence-v1", "feature_version": contract.Contract().version, "sequence_length": 32, "stride": 8, "sample_id": "s", "ue_key": "u", "model_input": ([[1, 0, 0, 0]] * 32, [[0.5, -1.0]] * 32), "evidence": ([("l_tau",)] * 32,)}
    cats, nums = sound["model_input"]
    faults = {
        "schema_version": {"schema_version": "gold-sequence-v2"}, "feature_version": {"feature_version": None}, "sequence_length": {"sequence_length": 31}, "stride": {"stride": 7}, "sample_id": {"sample_id": ""}, "ue_key": {"ue_key": None},
        "x_cat shape": {"model_input": (cats[:31], nums)}, "x_num shape": {"model_input": (cats, [[0.5]] * 32)}, "x_cat range": {"model_input": ([[0, 0, 0, 0]] * 32, nums)}, "x_num range": {"model_input": (cats, [[1.5, 0.0]] * 32)}, "evidence length": {"evidence": ([("l_tau",)],)},
    }
    rows = [tuple((sound | change).values()) for change in ({}, *faults.values())]
    got = [r[0] for r in spark.createDataFrame(rows, ddl).coalesce(1).select(sequences.contract_fault()).collect()]
    assert got == [None, *faults]


def test_reasons_of_side_outputs(spark):
    ddl = "raw_record_id string, msisdn string, imsi string, mtmsi string"
    rows = [("a", None, None, " "), ("b", "x", "", "zz"), ("c", "+49 170 55555", None, None), ("d", None, "12", "AB"), ("e", None, "", "0xab"), ("f", "4917055556", None, "AB")]
    dims = [silver.identity_dimension(spark.createDataFrame([("4917055556", "777777")], "msisdn string, imsi string"), "msisdn"), silver.identity_dimension(spark.createDataFrame([("ab", "888888")], "mtmsi string, imsi string"), "mtmsi")]
    out = silver.resolve_identity(spark.createDataFrame(rows, ddl), *dims)
    assert {r.raw_record_id: r.reason for r in out["invalid_identity"].collect()} == {"a": "MISSING_IMSI_AND_ALIASES", "b": "INVALID_IDENTITY_ALIASES", "c": "IDENTITY_MAPPING_NOT_FOUND", "d": "INVALID_DIRECT_IMSI"}
    assert {r.raw_record_id: (r.ue_key, r.resolution_source) for r in out["resolved"].collect()} == {"e": ("888888", "MTMSI_MAPPING"), "f": ("777777", "MSISDN_MAPPING")}


def test_late_borders(spark):
    df = spark.createDataFrame([(0, 100_000), (1, 70_000), (2, 69_999)], "a int, ts long").withColumn("k", F.lit(1))
    assert [r.ts for r in silver.split_late(df, ts="ts", arrival=["a"], key=["k"])["late"].collect()] == [69_999]
    assert [r.ts for r in sequences.split_too_late(df, key="k", ts="ts", arrival=["a"])["too_late"].orderBy("ts").collect()] == [69_999, 70_000]


def test_encoding(spark):
    e = ("l_tau", "success", "9", "413", 1000, 5)
    event = "struct<event_id:string,event_result:string,normalized_cause_code:string,sub_cause_code:string,duration_ms:bigint,request_retries:int>"
    first = [("l_attach", "reject", "", "", 0, 0), ("l_service_request", "success", "10", "107", 600_000, 10)]
    unknown = [e] * 31 + [("l_tau", "success", "odd", "413", None, None)]
    df = spark.createDataFrame([(0, first + [e] * 30), (1, unknown), (2, [e] * 31)], f"i int, events array<{event}>")
    good, bad, short = sequences.encode(df).orderBy("i").collect()
    assert good.fault is None and good.x_cat[0] == [1, 2, 0, 0] and good.x_cat[1] == [9, 3, 2, 4] and good.x_cat[2] == [10, 3, 25, 29]
    assert good.x_num[0] == [0, 0] and good.x_num[1] == [1, 1] and good.x_num[2][1] == 0.5
    assert (bad.fault.feature_name, bad.fault.reason, bad.fault.rejected_value) == ("normalized_cause_code", "UNKNOWN_CATEGORY", "odd") and list(bad.x_num[31]) == [-1, -1]
    assert short.fault.reason == "INVALID_SEQUENCE_LENGTH"


def test_alert_summary_takes_the_first_of_equals(spark):
    rows = [("a", 1, "t1", True, 0.9), ("a", 2, "t2", True, 0.9), ("a", 3, "t3", True, 0.8), ("a", 4, "t3", True, 0.85)]
    df = spark.createDataFrame(rows, "ue_key string, arrival int, window_end_event_time string, is_anomaly boolean, anomaly_score double")
    got = analytics.alert_summary(df).first()
    assert (got.max_score, got.max_score_window_end, got.latest_window_end, got.latest_score) == (0.9, "t1", "t3", 0.8)


def test_analytics(spark):
    rows = [("a", i, f"2024-01-01T00:00:{i:02d}Z", hit, 0.5 + i / 100) for i, hit in enumerate([True, True, False, True, True, True])] + [("b", 9, "2024-01-01T00:00:09Z", False, 0.1)]
    df = spark.createDataFrame(rows, "ue_key string, arrival int, window_end_event_time string, is_anomaly boolean, anomaly_score double")
    got = analytics.alert_summary(df).collect()
    assert [(r.ue_key, r.longest_run, r.severity, r.anomaly_count) for r in got] == [("a", 3, "high", 5)]
    assert analytics.kpis(df).first().anomaly_rate == pytest.approx(5 / 7)
    assert analytics.kpis(df.limit(0)).first().anomaly_rate == 0
    assert [r.ue_key for r in got] == ["a"] and [r.arrival for r in analytics.history(df.withColumn("model", F.lit("m")), "a").collect()] == list(range(6))
    points = analytics.chart_points(df.withColumn("ms", F.col("arrival") * 1000), ts_ms="ms", score="anomaly_score").collect()
    assert [p.ms for p in points] == sorted(p.ms for p in points) and points[0].label == "0.500"
    assert values(spark, analytics.rate_label, ["0.1234", "0", "1"]) == ["12.34%", "0.00%", "100.00%"]
    assert [r[0] for r in spark.createDataFrame([(80,), (81,), (48_000,), (48_001,)], "s long").select(analytics.bucket_seconds(F.col("s"))).collect()] == [1, 2, 600, 1200]
