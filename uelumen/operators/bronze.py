"""Raw records to Bronze events, or to the dead-letter table with the first fault in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uelumen.contract import RAW_FIELDS
from uelumen.functions import times
from uelumen.functions.text import is_blank, nullable_number, number_fault, sha256, strip, strip_to_null
from uelumen.operators.routes import Routed, settle
from uelumen.schemas import ENVELOPE
from uelumen.sources.ingest import ENVELOPE_VERSION


_AT = {name: i for i, name in enumerate(RAW_FIELDS)}


def _field(name: str) -> Column:
    """A raw field by its place; null where the line has another number of fields."""
    return F.get("fields", F.lit(_AT[name]))


def _iso_of_millis(ms: Column) -> Column:
    return F.when(ms >= 0, times.normalise(F.lpad(ms.cast("string"), 13, "0")))


def parse(records: DataFrame, *, zone: str = "Asia/Ho_Chi_Minh", delimiter: str = ";", version: str = ENVELOPE_VERSION, ingest_time: Column | None = None) -> DataFrame:
    """Every record with ``error`` (struct of code and message, null if sound) beside its parsed parts.

    JSON text ``null`` and JSON that is no object have no envelope and count as INVALID_ENVELOPE_SCHEMA and
    INVALID_ENVELOPE_JSON. Nothing here raises on bad data.
    """
    value = F.col("value")
    rows = settle(records, env=F.from_json(value, ENVELOPE + ", ul_corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "ul_corrupt"}))
    payload = F.col("env.raw_payload")
    literal = "\\" + delimiter if len(delimiter) == 1 and not delimiter.isalnum() else rf"\Q{delimiter}\E"
    parts = F.when(~is_blank(payload), F.split(payload, literal, -1))
    rows = settle(rows, line=F.when(F.col("env.source_line").rlike(r"\A-?\d+\z"), F.col("env.source_line").try_cast("long")), parts=parts)
    blank_parts = F.forall("parts", lambda p: is_blank(p))
    rows = settle(rows, fields=F.when(F.size("parts") == len(RAW_FIELDS), F.col("parts")))
    get = _field
    rows = settle(rows, event_time=times.normalise(get("EVENT_TIME"), zone))
    is_null_json = strip(value) == "null"
    checks = [
        (value.isNull(), "NULL_KAFKA_VALUE", F.lit("the record has no value")),
        (~is_null_json & (F.col("env").isNull() | F.col("env.ul_corrupt").isNotNull()), "INVALID_ENVELOPE_JSON", F.lit("the value is no JSON object")),
        (is_null_json | is_blank(F.col("env.schema_version")), "INVALID_ENVELOPE_SCHEMA", F.lit("schema_version is missing")),
        (F.col("env.schema_version") != version, "UNSUPPORTED_ENVELOPE_SCHEMA_VERSION", F.concat(F.lit("schema_version is "), F.col("env.schema_version"))),
        (is_blank(F.col("env.raw_record_id")), "INVALID_ENVELOPE_SCHEMA", F.lit("raw_record_id is missing")),
        (is_blank(F.col("env.source_file")), "INVALID_ENVELOPE_SCHEMA", F.lit("source_file is missing")),
        (F.col("line").isNull() | (F.col("line") < 1), "INVALID_ENVELOPE_SCHEMA", F.lit("source_line is missing or below 1")),
        (is_blank(payload), "EMPTY_RAW_PAYLOAD", F.lit("the payload is blank")),
        (F.size("parts") != len(RAW_FIELDS), "WRONG_RAW_FIELD_COUNT", F.concat(F.lit(f"Expected {len(RAW_FIELDS)} fields but received "), F.size("parts").cast("string"))),
        (blank_parts, "EMPTY_RAW_PAYLOAD", F.lit("all fields are blank")),
        (F.col("event_time").isNull(), "INVALID_EVENT_TIME", F.concat(F.lit("EVENT_TIME is "), F.coalesce(get("EVENT_TIME"), F.lit("")))),
        (number_fault(get("DURATION")), "INVALID_DURATION", F.concat(F.lit("DURATION is "), get("DURATION"))),
        (number_fault(get("REQUEST_RETRIES"), "int"), "INVALID_REQUEST_RETRIES", F.concat(F.lit("REQUEST_RETRIES is "), get("REQUEST_RETRIES"))),
        (number_fault(get("PAGING_ATTEMPTS"), "int"), "INVALID_PAGING_ATTEMPTS", F.concat(F.lit("PAGING_ATTEMPTS is "), get("PAGING_ATTEMPTS"))),
    ]
    error = F.lit(None)
    for fault, code, message in reversed(checks):
        error = F.when(fault, F.struct(F.lit(code).alias("code"), message.alias("message"))).otherwise(error)
    source = F.struct(
        F.col("env.source_file").alias("source_file"), F.col("line").alias("source_line"), "topic", "partition", "offset",
        _iso_of_millis(F.col("kafka_timestamp")).alias("kafka_timestamp"), (times.now_iso() if ingest_time is None else ingest_time).alias("ingest_time"),
    )
    return settle(rows, error=error, source=source)


def split(parsed: DataFrame) -> Routed:
    """``bronze`` events and ``dlq`` records."""
    get = _field
    text = lambda name: strip_to_null(get(name))
    raw_fields = F.map_from_arrays(F.array(*map(F.lit, RAW_FIELDS)), "fields").alias("raw_fields")
    bronze = parsed.filter("error IS NULL").select(
        F.lit("bronze-v1").alias("schema_version"), F.col("env.raw_record_id").alias("raw_record_id"), text("EVENT_ID").alias("event_id"), strip(get("EVENT_RESULT")).alias("event_result"),
        nullable_number(get("DURATION")).alias("duration_ms"), nullable_number(get("REQUEST_RETRIES"), "int").alias("request_retries"), nullable_number(get("PAGING_ATTEMPTS"), "int").alias("paging_attempts"),
        "event_time", F.lit("source").alias("event_time_quality"),
        *[text(n.upper()).alias(n) for n in "msisdn imsi mtmsi imeisv mmegi mmec sub_cause_code msc tac eci sgw pdn_pgw".split()],
        raw_fields, "source",
    )
    where = F.concat_ws(":", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    own_id = F.col("env.raw_record_id")
    dlq = parsed.filter("error IS NOT NULL").select(
        F.lit("bronze-dlq-v1").alias("schema_version"), sha256(F.lit("bronze-dlq:"), where, F.lit(":"), F.col("error.code")).alias("dlq_id"),
        F.when(is_blank(own_id), F.sha2(where, 256)).otherwise(own_id).alias("raw_record_id"), F.col("error.code").alias("error_code"), F.col("error.message").alias("error_message"),
        F.col("source.ingest_time").alias("failed_at"), F.col("value").alias("original_message"), "source",
    )
    return Routed({"bronze": bronze, "dlq": dlq})


def bronze(records: DataFrame, **options) -> Routed:
    return split(parse(records, **options))
