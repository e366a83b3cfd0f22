"""The streaming jobs: raw records to Bronze, Silver, Gold and predictions, each from its topic to its topics.

A job is one or two named queries with a checkpoint of its own, so a restart goes on where the last committed batch ended and the state keeps its
place; names and state columns are part of what must not change between versions. All outputs of a batch (for predictions: those of all models) are
published by one commit in ``foreachBatch``, under the names of the job and the batch, before Spark notes the batch as done; a batch that is repeated after a failure
finds what it has published.

Silver needs two queries: identity and catalogue have side outputs before duplicates and lateness need state. Between them stands an internal topic.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from uelumen.contract import Contract
from uelumen.functions.times import epoch_millis
from uelumen.operators import bronze, scoring, sequences, silver
from uelumen.operators.analytics import BUFFER_ROWS, latest
from uelumen.operators.routes import Routed
from uelumen.plans.layers import Dimensions
from uelumen.plans.stage import delete
from uelumen.schemas import BRONZE, GOLD, GOLD_INPUT, SILVER, TOPICS
from uelumen.sources import ingest
from uelumen.streaming import processors

CANDIDATES = ("internal.silver.candidate", "silver_event_id")


@dataclass(frozen=True)
class Settings:
    """``checkpoints``: a folder that all executors share. ``once`` handles what is there and ends; else a batch begins every ``trigger_s``."""

    checkpoints: str
    trigger_s: int = 60
    once: bool = False
    start: str = "earliest"
    tolerance_ms: int = 30_000
    idle_ms: int = 60_000
    ttl_ms: int = processors.TTL_MS

    def __post_init__(self):
        if self.trigger_s <= 0 or self.tolerance_ms < 0 or self.idle_ms <= 0 or self.ttl_ms <= 0:
            raise ValueError("trigger, tolerance, idle time or TTL out of range")
        ingest.check_start(self.start)


def publish(transport, job: str, routed: dict[str, tuple[DataFrame, str, str]], batch_id: int, order: dict[str, list[str]] | None = None, partition=None) -> dict[str, int]:
    """Each output (rows, topic, key column) to its topic, all in one commit of the job's batch; how many messages each had."""
    outputs = []
    for name, (rows, topic, key) in routed.items():
        order_by = (order or {}).get(name)
        carried = rows.select("*", *[F.col(c).alias(f"ul_order{i}") for i, c in enumerate(order_by or [])])
        made = ingest.to_messages(rows, topic, key, partition if name == "bronze" else None, carry=carried if order_by else None)
        outputs.append((made, [c for c in made.columns if c.startswith("ul_order")] or None))
    sent = transport.commit(outputs, batch_id, job)
    return {name: sent.get(topic, 0) for name, (_, topic, _) in routed.items()}


def _start(name: str, stream: DataFrame, settings: Settings, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    writer = stream.writeStream.queryName(name).option("checkpointLocation", f"{settings.checkpoints.rstrip('/')}/{name}").foreachBatch(handle)
    if not settings.once:
        return writer.trigger(processingTime=f"{settings.trigger_s} seconds").start()
    # an operator with processing-time state asks for batches without data for ever; a query takes the setting over as it starts
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(name, "true")
    conf.set(name, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        conf.set(name, before)


def _routes(outputs: Routed, topics: dict[str, str]) -> dict[str, tuple[DataFrame, str, str]]:
    return {name: (outputs[name], *TOPICS[topics[name]]) for name in outputs if name in topics}


def bronze_job(spark: SparkSession, transport, settings: Settings, **options) -> StreamingQuery:
    """Raw records to Bronze, in the partition of the source record, and dead letters."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        parsed = bronze.parse(batch, **options).persist()
        try:
            publish(transport, "bronze", _routes(bronze.split(parsed), {"bronze": "bronze", "dlq": "bronze_dlq"}), batch_id, {"bronze": ["source.offset"], "dlq": ["source.offset"]}, F.col("source.partition"))
        finally:
            parsed.unpersist()

    return _start("bronze", transport.stream(spark, TOPICS["raw"][0], start=settings.start), settings, handle)


def silver_jobs(spark: SparkSession, transport, settings: Settings, dims: Dimensions) -> list[StreamingQuery]:
    """Bronze to Silver, late events, and the two side outputs."""

    def route(batch: DataFrame, batch_id: int) -> None:
        events = ingest.strict_json(batch, BRONZE)
        resolved = silver.resolve_identity(events, dims.by_msisdn, dims.by_mtmsi)
        known = silver.normalise_events(resolved["resolved"], dims.catalogue)
        side = _routes(resolved, {"invalid_identity": "invalid_identity"}) | _routes(known, {"unsupported_event": "unsupported_event"})
        publish(transport, "silver-route", side | {"candidate": (known["silver"], *CANDIDATES)}, batch_id, {"candidate": ["source.topic", "source.partition", "source.offset"]})

    processors.use_rocksdb(spark)
    routing = _start("silver-route", transport.stream(spark, TOPICS["bronze"][0], start=settings.start), settings, route)
    if settings.once:
        routing.awaitTermination()
    rows = ingest.strict_json(transport.stream(spark, CANDIDATES[0]), SILVER)
    rows = rows.select("*", F.concat_ws(":", "source.topic", "source.partition").alias("ul_part"), F.col("source.offset").alias("ul_offset"), epoch_millis(F.col("event_time")).alias("ul_ms"))
    first = processors.dedup_stream(rows, ["ul_part", "ul_offset"], settings.ttl_ms, order="ul_offset")
    timed = processors.late_stream(first, "ul_part", "ul_ms", settings.tolerance_ms, order="ul_offset")

    def split(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            own = [c for c in batch.columns if not c.startswith("ul_") and c != "late"]
            outputs = Routed({"silver": batch.filter(~F.col("late")).select(own), "late": batch.filter("late").select(own)})
            publish(transport, "silver", _routes(outputs, {"silver": "silver", "late": "silver_late"}), batch_id, {"silver": ["source.offset"], "late": ["source.offset"]})
        finally:
            batch.unpersist()

    return [routing, _start("silver", timed, settings, split)]


def gold_job(spark: SparkSession, transport, settings: Settings, contract: Contract | None = None) -> StreamingQuery:
    """Silver to Gold sequences, too-late events and invalid features."""
    contract = contract or Contract()
    processors.use_rocksdb(spark)
    rows = ingest.strict_json(transport.stream(spark, TOPICS["silver"][0], start=settings.start), SILVER, carry=("offset",))
    events = sequences.to_gold_events(rows, contract, carry=["offset"])  # a subscriber's events lie in one partition
    names = [c for c in events.columns if c != "offset"]
    packed = events.select("ue_key", "event_time_epoch_ms", "source_order_key", "offset", F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("body"))
    made = processors.sequence_stream(packed, length=contract.length, stride=contract.stride, tolerance_ms=settings.tolerance_ms, idle_ms=settings.idle_ms, ttl_ms=settings.ttl_ms, arrival="offset")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("e", F.from_json("body", GOLD_INPUT)).persist()
        try:
            windows = batch.filter("route = 'window'").groupBy("ue_key", "window_no").agg(F.array_sort(F.collect_list(F.struct("position", "e")), lambda a, b: (a["position"] - b["position"]).cast("int")).alias("w"))
            windows = windows.select("ue_key", "window_no", F.transform("w", lambda x: x["e"]).alias("events"))
            outputs = sequences.samples_of(windows, contract)
            late = batch.filter("route = 'too_late'").select("e.*")
            publish(transport, "gold", _routes(outputs, {"gold": "gold", "invalid_feature": "invalid_feature"}) | {"too_late": (late, *TOPICS["too_late"])}, batch_id)
        finally:
            batch.unpersist()

    return _start("gold", made, settings, handle)


def scoring_job(spark: SparkSession, transport, settings: Settings, models: Sequence, contract: Contract | None = None) -> StreamingQuery:
    """Gold sequences to predictions of all models. A sequence that breaks the contract fails the batch, which stays uncommitted."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        gold = ingest.strict_json(batch, GOLD)
        checked = gold.withColumn("sample_id", F.when(sequences.contract_fault(contract).isNull(), F.col("sample_id")).otherwise(F.raise_error(F.concat(F.lit("a gold sequence breaks the contract: "), sequences.contract_fault(contract)))))
        publish(transport, "scoring", {"predictions": (scoring.predictions(checked, models), *TOPICS["predictions"])}, batch_id)

    return _start("scoring", transport.stream(spark, TOPICS["gold"][0], start=settings.start), settings, handle)


def _batches(spark: SparkSession, path: str) -> list[int]:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(target) if fs.exists(f.getPath().suffix("/_SUCCESS"))] if fs.exists(target) else []
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def buffer_job(spark: SparkSession, transport, settings: Settings, path: str, *, keep: int = BUFFER_ROWS, shards: int = 16) -> StreamingQuery:
    """The dashboard's buffer: the last arrival of each prediction id, of these the newest ``keep``, in a table at ``path``.

    Shards hold the state by id; a batch's changes and the table of the batch before make the next table. A batch that is repeated
    reads the same table and overwrites its own; a new query from ``earliest`` comes to the same rows. Arrival: broker time, then partition and offset. A missing or blank id
    is replaced by the place of its record.
    """
    processors.use_rocksdb(spark)
    stream = transport.stream(spark, TOPICS["predictions"][0], start=settings.start)
    parts = [F.lpad(F.col(c).cast("string"), n, "0") for c, n in (("kafka_timestamp", 15), ("partition", 6), ("offset", 19))]
    ident = F.coalesce(F.nullif(F.get_json_object("value", "$.prediction_id"), F.lit("")), F.concat_ws(":", "partition", "offset"))
    rows = stream.select(ident.alias("id"), F.concat_ws("-", *parts).alias("arrival"), "value")
    changes = processors.latest_stream(rows, ident="id", arrival="arrival", keep=keep, shards=shards)

    def merge(batch: DataFrame, batch_id: int) -> None:
        put = batch.filter("change = 'put'").select("id", "arrival", "value")  # what a shard evicts is older than its newest ``keep``
        earlier = [b for b in _batches(spark, path) if b < batch_id]
        held = put if not earlier else put.union(spark.read.schema(put.schema).parquet(f"{path}/batch={earlier[-1]}"))
        latest(held, key="id", keep=keep).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        for old in earlier[:-1]:
            delete(spark, f"{path}/batch={old}")

    return _start("buffer", changes, settings, merge)


def read_buffer(spark: SparkSession, path: str) -> DataFrame:
    """(id, arrival, value) of the buffer after its last batch."""
    found = _batches(spark, path)
    schema = "id string, arrival string, value string"
    return spark.read.schema(schema).parquet(f"{path}/batch={found[-1]}") if found else spark.createDataFrame([], schema)


def produce(spark: SparkSession, transport, directory: str, batch_id: int = 0) -> int:
    """Publish the lines of a log directory as raw envelopes; an error unless every line was published."""
    lines = ingest.read_lines(spark, directory)
    rows = ingest.envelopes(lines)
    topic, key = TOPICS["raw"]
    sent = publish(transport, "producer", {"raw": (rows, topic, key)}, batch_id, {"raw": ["source_file", "source_line"]})["raw"]
    if sent != (read := lines.count()):
        raise RuntimeError(f"{read} lines were read and {sent} published")
    return sent


def probe(spark: SparkSession, transport, contract: Contract | None = None) -> dict:
    """The first sound Gold sequence, as a dictionary; an error if there is none."""
    gold = ingest.strict_json(transport.read(spark, TOPICS["gold"][0]), GOLD)
    sound = gold.filter(sequences.contract_fault(contract).isNull()).limit(1).toJSON().collect()
    if not sound:
        raise ValueError("no gold sequence keeps the contract")
    import json

    return json.loads(sound[0])
