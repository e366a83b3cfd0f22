"""The synthetic ``events`` table as subscriber telemetry, for queries that run on it.

user -> subscriber, event_type -> event id (in spellings that need normalising), value -> duration, ``props.k`` -> cause,
event_id -> result, retries and injected faults. Arrival is a bounded shuffle of event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uelumen.contract import RAW_FIELDS
from uelumen.sources.ingest import record_id

TOLERANCE_MS = 6 * 3600 * 1000
JITTER_S = 12 * 3600
EVENT_OF = {"click": "l_service_request", "view": "l_tau", "purchase": " L-Attach ", "signup": "l_detach", "error": "L_Handover"}
RESULTS = ["success", " Reject ", "", "ABORT", "success", "odd"]


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n, user_id, ts_ms, event_type, duration_ms, retries, k, arrival_key."""
    ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', cast(ts AS timestamp_ntz))")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("n"), "user_id", ms.alias("ts_ms"), "event_type", F.floor(F.col("value") * 1000).cast("long").alias("duration_ms"), (F.col("event_id") % 12).cast("int").alias("retries"),
        F.get_json_object("props", "$.k").cast("int").alias("k"), (F.floor(ms / 1000) + F.col("event_id") * 7919 % JITTER_S).alias("arrival_key"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines (source_file, source_line, raw_payload) of the events, 52 fields each."""
    rows = base(spark, sf_dir)
    event = F.try_element_at(F.create_map(*[F.lit(x) for kv in EVENT_OF.items() for x in kv]), F.col("event_type"))
    result = F.get(F.array(*map(F.lit, RESULTS)), (F.col("n") % len(RESULTS)).cast("int"))
    imsi = F.concat(F.lit("45204"), F.lpad(F.col("user_id").cast("string"), 10, "0"))
    known = {
        "EVENT_ID": event, "EVENT_RESULT": result, "DURATION": F.col("duration_ms").cast("string"), "REQUEST_RETRIES": F.col("retries").cast("string"),
        "IMSI": F.when(F.col("n") % 4 == 0, imsi).when(F.col("n") % 97 == 1, "12AB").otherwise(""), "MSISDN": F.when(F.col("n") % 4 == 1, F.concat(F.lit("+84 "), F.lpad(F.col("user_id").cast("string"), 9, "0"))).otherwise(""),
        "MTMSI": F.when(F.col("n") % 4 == 2, F.concat(F.lit("0x"), F.lower(F.hex(F.col("user_id") + 4096)))).otherwise(""), "CAUSE_CODE": F.when(F.col("k") % 3 == 0, "9").otherwise(""), "SUB_CAUSE_CODE": F.when(F.col("k") % 5 == 0, "413").otherwise(""),
        "EVENT_TIME": F.col("ts_ms").cast("string"), "TAC": (F.col("k") + 200).cast("string"), "ECI": (F.col("k") + 300).cast("string"), "PAGING_ATTEMPTS": F.lit("1"),
        "SUB_TYPE": F.when(F.col("n") % 5 == 0, F.concat(F.lit(" "), (F.col("n") % 3).cast("string"), F.lit(" "))).otherwise(""), "SGSN": F.when(F.col("n") % 9 == 0, F.concat(F.lit("SGSN"), F.col("k").cast("string"))).otherwise(""),
    }
    payload = F.concat_ws(";", *[known.get(f, F.lit("")) for f in RAW_FIELDS])
    return rows.select("n", "user_id", "ts_ms", "duration_ms", "retries", "k", "event_type", F.concat(F.lit("log_"), (F.col("n") % 7).cast("string")).alias("source_file"), (F.col("n") + 1).alias("source_line"), payload.alias("raw_payload"))


FAULTS = 20


def kafka_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records as a broker would hand them on; of 20 in a row, 12 have a fault each."""
    rows = raw_lines(spark, sf_dir)
    kind = (F.col("n") % FAULTS).cast("int")
    swap = lambda i, text: F.concat_ws(";", F.transform(F.split("raw_payload", ";", -1), lambda x, j: F.when(j == i, F.lit(text)).otherwise(x)))
    at = {f: i for i, f in enumerate(RAW_FIELDS)}
    payload = (
        F.when(kind == 7, "   ").when(kind == 8, F.regexp_replace("raw_payload", ";[^;]*$", "")).when(kind == 9, ";" * (len(RAW_FIELDS) - 1)).when(kind == 10, swap(at["EVENT_TIME"], "2026-02-30 10:00:00"))
        .when(kind == 11, swap(at["DURATION"], "-1")).when(kind == 12, swap(at["REQUEST_RETRIES"], "1.5")).when(kind == 13, swap(at["PAGING_ATTEMPTS"], "9999999999")).otherwise(F.col("raw_payload"))
    )
    envelope = F.struct(
        F.when(kind == 3, "raw-envelope-v9").otherwise("raw-envelope-v1").alias("schema_version"), F.when(kind == 4, " ").otherwise(record_id(F.col("source_file"), F.col("source_line"), F.col("raw_payload"))).alias("raw_record_id"),
        F.when(kind == 5, "").otherwise(F.col("source_file")).alias("source_file"), F.when(kind == 6, F.lit(0)).otherwise(F.col("source_line")).alias("source_line"), payload.alias("raw_payload"), F.lit("x").alias("unknown_field"),
    )
    value = F.when(kind == 1, F.lit(None)).when(kind == 2, "{broken").otherwise(F.to_json(envelope))
    return rows.select(F.lit("raw.ue.log.line").alias("topic"), (F.col("n") % 3).cast("int").alias("partition"), F.col("n").alias("offset"), F.col("ts_ms").alias("kafka_timestamp"), value.alias("value"))


def identity_mappings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two thirds of the users have an MSISDN and an MTMSI entry."""
    users = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").distinct().filter("user_id % 3 <> 0")
    imsi = F.concat(F.lit("45204"), F.lpad(F.col("user_id").cast("string"), 10, "0"))
    return (
        users.select(F.concat(F.lit("84"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("msisdn"), imsi.alias("imsi")),
        users.select(F.upper(F.hex(F.col("user_id") + 4096)).alias("mtmsi"), imsi.alias("imsi")),
    )
