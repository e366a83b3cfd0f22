"""The streaming jobs on topics in folders give what the batch layers give; restarts, repeats and failures."""

import json
import time

import pytest
from pyspark.sql import functions as F

from uelumen import config
from uelumen.contract import RAW_FIELDS, ContractError
from uelumen.operators import scoring, sequences
from uelumen.plans import layers
from uelumen.schemas import BRONZE, GOLD, SILVER, TOPICS
from uelumen.sources import ingest
from uelumen.streaming import jobs, transport

START = 1_700_000_000_000


def line(i, **fields):
    known = {"EVENT_ID": "L-TAU", "EVENT_RESULT": "success", "DURATION": str(10 * i), "REQUEST_RETRIES": "1", "PAGING_ATTEMPTS": "0", "IMSI": "452040000000001", "EVENT_TIME": str(START + i * 1000), "CAUSE_CODE": "9", "SUB_CAUSE_CODE": ""}
    return ";".join((known | fields).get(f, "") for f in RAW_FIELDS)


def lines():
    rows = [line(i) for i in range(60)]
    rows[5], rows[6], rows[7] = "a;b", line(6, IMSI="", MSISDN="+84 900-000-001"), line(7, IMSI="", MTMSI="0xFFFF")
    rows[8], rows[9] = line(8, EVENT_ID="no such"), line(9, IMSI="12")
    rows.append(line(200))  # far ahead
    rows.append(line(100))  # behind it by more than the tolerance
    return rows


@pytest.fixture()
def settings(tmp_path):
    raw = {"identity": {"msisdn": {84900000001: 452040000000001}, "mtmsi": {}}, "job": {"checkpoints": f"file://{tmp_path}/checkpoints", "once": True}}
    (tmp_path / "job.json").write_text(json.dumps(raw))
    return config.read(str(tmp_path / "job.json"))


def run(query):
    assert query.awaitTermination(240)
    assert query.exception() is None


def test_jobs_match_batch(spark, tmp_path, settings):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        (tmp_path / "logs").mkdir()
        (tmp_path / "logs" / "a.log").write_text("\n".join(lines()) + "\n")
        topics = transport.FileTransport(f"file://{tmp_path}/topics", partitions=1)
        job = config.settings(settings)
        dims = config.dimensions(spark, settings)
        assert jobs.produce(spark, topics, f"file://{tmp_path}/logs") == 62
        read = lambda name: topics.read(spark, TOPICS[name][0])
        raw = read("raw").drop("key")
        assert [r.offset for r in raw.orderBy("offset").collect()] == list(range(1, 63))

        run(jobs.bronze_job(spark, topics, job))
        made = layers.bronze_layer(raw)
        assert (read("bronze").count(), read("bronze_dlq").count()) == (made["bronze"].count(), made["dlq"].count()) == (61, 1)
        assert read("bronze").filter("partition <> 0 OR key = ''").count() == 0
        run(jobs.bronze_job(spark, topics, job))  # nothing new: a restart publishes nothing again
        assert read("bronze").count() == 61

        for query in jobs.silver_jobs(spark, topics, job, dims):
            run(query)
        want = layers.silver_layer(ingest.strict_json(read("bronze"), BRONZE), dims)
        for name, topic in (("silver", "silver"), ("late", "silver_late"), ("invalid_identity", "invalid_identity"), ("unsupported_event", "unsupported_event")):
            assert sorted(r.key for r in read(topic).collect()) == sorted(r[0] for r in want[name].select(TOPICS[topic][1]).collect()), name
        assert (read("silver").count(), read("silver_late").count(), read("invalid_identity").count(), read("unsupported_event").count()) == (57, 1, 2, 1)

        run(jobs.gold_job(spark, topics, job))
        silver = ingest.strict_json(read("silver"), SILVER)
        batch = layers.gold_layer(silver.filter(F.col("event_time") < "2023-11-14T22:15:00Z"))["gold"]
        gold = ingest.strict_json(read("gold"), GOLD)
        ids = sorted(r.sample_id for r in gold.collect())
        assert ids == sorted(r.sample_id for r in batch.collect()) and len(ids) == 4  # the event far ahead still waits
        assert jobs.probe(spark, topics)["sample_id"] in ids
        assert gold.filter(sequences.contract_fault().isNotNull()).count() == 0

        models = [scoring.calibrate(gold, model_name=n) for n in ("a", "b")]
        run(jobs.scoring_job(spark, topics, job, models))
        got = [json.loads(r.value) for r in read("predictions").collect()]
        assert sorted((p["sample_id"], p["model"]) for p in got) == [(i, m) for i in ids for m in "ab"]
        assert {r.key for r in read("predictions").collect()} == {"452040000000001"}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_a_repeated_batch_overwrites_itself(spark, tmp_path):
    topics = transport.FileTransport(f"file://{tmp_path}/t")
    rows = spark.createDataFrame([("b", 2), ("a", 1)], "id string, n int")
    for _ in range(2):
        assert jobs.publish(topics, "x", {"x": (rows, "some.topic", "id")}, 7, {"x": ["n"]}) == {"x": 2}
    got = topics.read(spark, "some.topic").collect()
    assert len(got) == 2 and {json.loads(r.value)["n"] for r in got} == {1, 2} and all(r.offset > 7 * transport.BATCH_OFFSETS for r in got)
    with pytest.raises(Exception, match="blank key"):
        jobs.publish(topics, "x", {"x": (spark.createDataFrame([(" ", 1)], "id string, n int"), "t", "id")}, 0)
    with pytest.raises(Exception, match="negative partition"):
        ingest.to_messages(rows, "t", "id", F.lit(-1)).collect()
    assert topics.read(spark, "never.written").count() == 0


def test_strict_records(spark):
    ddl = "a string, b int"
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "value string")
    assert [tuple(r) for r in ingest.strict_json(rows('{"a":"x","b":1}', '{"a":null}'), ddl).collect()] == [("x", 1), (None, None)]
    for bad, why in (("", "empty value"), (None, "empty value"), ("[1]", "not a JSON object"), ('{"a":"x","c":1}', "unknown fields"), ('{"b":"x"}', "MALFORMED")):
        with pytest.raises(Exception, match=why):
            ingest.strict_json(rows(bad), ddl).collect()


def test_a_broken_sequence_is_not_committed(spark, tmp_path, settings):
    topics = transport.FileTransport(f"file://{tmp_path}/topics")
    empty = spark.createDataFrame([("gold-sequence-v1", "other", "s", "u")], "schema_version string, feature_version string, sample_id string, ue_key string")
    jobs.publish(topics, "gold", {"gold": (empty, *TOPICS["gold"])}, 0)
    query = jobs.scoring_job(spark, topics, config.settings(settings), [scoring.DeviationModel()])
    with pytest.raises(Exception):
        query.awaitTermination(120)
    assert "breaks the contract" in str(query.exception()) and topics.read(spark, TOPICS["predictions"][0]).count() == 0
    with pytest.raises(ValueError):
        jobs.probe(spark, topics)


def test_configuration(spark, tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("job: {checkpoints: /x, trigger_s: 5}\nidentity:\n  mtmsi: {'0xab': 452040000000007}\nevents:\n  l_tau: {name: Tracking area, aliases: [TAU, L-Tau]}\n")
    raw = config.read(str(path))
    assert config.settings(raw, trigger_s=9).trigger_s == 9 and config.settings(raw).tolerance_ms == 30_000
    dims = config.dimensions(spark, raw)
    assert [tuple(r) for r in dims.by_mtmsi.collect()] == [("AB", "452040000000007")]
    assert sorted(tuple(r) for r in dims.catalogue.collect()) == [("l_tau", "l_tau", "Tracking area"), ("tau", "l_tau", "Tracking area")]
    for bad in ({"job": {}}, {"job": {"checkpoints": "/x", "odd": 1}}):
        with pytest.raises(ContractError):
            config.settings(bad)
    with pytest.raises(ValueError):
        config.settings({"job": {"checkpoints": "/x", "start": "middle"}})
    with pytest.raises(ContractError):
        config.dimensions(spark, {"identity": {"email": {}}})
    with pytest.raises(ContractError):
        config.identity(spark, "msisdn", {"x": "452040000000007"})
    transport.check_topics()
    with pytest.raises(ValueError):
        transport.check_topics({"a": ("t", "k"), "b": ("t", "k")})


def test_latest_leaves_out_what_is_there(spark, tmp_path):
    topics = transport.FileTransport(f"file://{tmp_path}/topics")
    rows = spark.createDataFrame([("a", 1)], "id string, n int")
    jobs.publish(topics, "x", {"x": (rows, "t", "id")}, 0)
    time.sleep(0.1)
    query = topics.stream(spark, "t", start="latest").writeStream.format("memory").queryName("latest").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
    run(query)
    assert spark.table("latest").count() == 0


def test_a_batch_is_published_whole_and_once(spark, tmp_path, monkeypatch):
    """Killed before the commit: nothing to read, the next run brings all. Killed after it: the next run adds nothing."""
    root = f"file://{tmp_path}/topics"
    topics = transport.FileTransport(root, partitions=1)
    raw = spark.createDataFrame([(str(i), i) for i in range(6)], "raw_record_id string, n int")
    jobs.publish(topics, "producer", {"raw": (raw, *TOPICS["raw"])}, 0)
    whole = transport.FileTransport._publish

    def two_routes(batch, batch_id):
        rows = batch.selectExpr("get_json_object(value, '$.raw_record_id') AS id", "offset")
        sent = jobs.publish(topics, "job", {"even": (rows.filter("offset % 2 = 0"), "even", "id"), "odd": (rows.filter("offset % 2 = 1"), "odd", "id")}, batch_id)
        assert sent == {"even": 3, "odd": 3}

    def once():
        query = topics.stream(spark, TOPICS["raw"][0]).writeStream.foreachBatch(two_routes).option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
        try:
            query.awaitTermination(120)
        except Exception:  # the batch has failed
            pass
        return query.exception()

    def held():
        return [sorted(json.loads(r.value)["id"] for r in topics.read(spark, t).collect()) for t in ("even", "odd")]

    def before(fs, staging, target):
        raise OSError("killed before the commit")

    def after(fs, staging, target):
        whole(fs, staging, target)
        raise OSError("killed after the commit")

    monkeypatch.setattr(transport.FileTransport, "_publish", staticmethod(before))
    assert once() is not None and held() == [[], []]
    monkeypatch.setattr(transport.FileTransport, "_publish", staticmethod(after))
    assert once() is not None and held() == [["1", "3", "5"], ["0", "2", "4"]]
    monkeypatch.setattr(transport.FileTransport, "_publish", staticmethod(whole))
    assert once() is None and held() == [["1", "3", "5"], ["0", "2", "4"]]
    topics.clear_staging(spark)
    assert not (tmp_path / "topics" / "_staging").exists()
