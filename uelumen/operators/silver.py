"""Bronze to Silver: identity, event catalogue, duplicates and late events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uelumen.contract import EVENT_IDS, ContractError
from uelumen.functions import text, times
from uelumen.functions.text import sha256, strip, strip_to_null
from uelumen.operators import scans
from uelumen.operators.routes import Routed, settle

#: A dimension is broadcast up to this many bytes by the planner's estimate; beyond it, or where it can't tell, the join is left to adaptive execution.
BROADCAST_BYTES = 32 << 20


def small(df: DataFrame) -> DataFrame:
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def identity_dimension(mapping: DataFrame, kind: str) -> DataFrame:
    """(key, imsi) with both normalised; a bad entry or two subscribers for one key is an error."""
    rule = {"msisdn": text.msisdn, "mtmsi": text.mtmsi}[kind]
    made = mapping.select(rule(F.col(kind)).alias("key"), text.imsi(F.col("imsi")).alias("imsi"))
    bad = made.filter("key IS NULL OR imsi IS NULL").limit(1).count()
    clash = made.groupBy("key").agg(F.count_distinct("imsi").alias("n")).filter("n > 1").limit(1).count()
    if bad or clash:
        raise ContractError(f"{kind} mapping: " + ("an entry is not valid" if bad else "a key has two subscribers"))
    return made.distinct()


def event_catalogue(spark: SparkSession, entries: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(alias, canonical, event_name) of (alias, canonical, display name); aliases are normalised, conflicts are errors."""
    entries = entries or [(e, e, e.removeprefix("l_").replace("_", " ").title()) for e in EVENT_IDS]
    df = spark.createDataFrame(entries, "alias string, canonical string, event_name string").withColumn("alias", text.event_name(F.col("alias")))
    if df.filter(F.col("alias").isNull() | ~text.event_name(F.col("canonical")).eqNullSafe(F.col("canonical"))).count():
        raise ContractError("event catalogue: an alias is blank or a canonical name is not normalised")
    df = df.distinct()
    if df.count() != df.select("alias").distinct().count():
        raise ContractError("event catalogue: an alias has two meanings")
    return df


def resolve_identity(bronze: DataFrame, by_msisdn: DataFrame, by_mtmsi: DataFrame, *, failed_at: Column | None = None) -> Routed:
    """``resolved`` events with ue_key, imsi and resolution_source, and ``invalid_identity`` records.

    A direct IMSI comes first and, if it is not valid, nothing else is tried; then MSISDN, then MTMSI.
    """
    rows = settle(bronze, ul_imsi=text.imsi(F.col("imsi")), ul_msisdn=text.msisdn(F.col("msisdn")), ul_mtmsi=text.mtmsi(F.col("mtmsi")))
    rows = rows.join(small(by_msisdn.select(F.col("key").alias("ul_msisdn"), F.col("imsi").alias("ul_of_msisdn"))), "ul_msisdn", "left")
    rows = rows.join(small(by_mtmsi.select(F.col("key").alias("ul_mtmsi"), F.col("imsi").alias("ul_of_mtmsi"))), "ul_mtmsi", "left")
    direct = ~text.is_blank(F.col("imsi"))
    any_alias = ~text.is_blank(F.col("msisdn")) | ~text.is_blank(F.col("mtmsi"))
    reason = (
        F.when(direct, F.when(F.col("ul_imsi").isNull(), "INVALID_DIRECT_IMSI"))
        .when(~any_alias, "MISSING_IMSI_AND_ALIASES")
        .when(F.col("ul_msisdn").isNull() & F.col("ul_mtmsi").isNull(), "INVALID_IDENTITY_ALIASES")
        .when(F.coalesce("ul_of_msisdn", "ul_of_mtmsi").isNull(), "IDENTITY_MAPPING_NOT_FOUND")
    )
    via = F.when(direct, "DIRECT_IMSI").when(F.col("ul_of_msisdn").isNotNull(), "MSISDN_MAPPING").otherwise("MTMSI_MAPPING")
    own = F.when(direct, F.col("ul_imsi")).otherwise(F.coalesce("ul_of_msisdn", "ul_of_mtmsi"))
    rows = settle(rows, ul_reason=reason, ue_key=own, resolution_source=via)
    columns = [F.col(c) for c in bronze.columns if c != "imsi"]
    resolved = rows.filter("ul_reason IS NULL").select("ue_key", F.col("ue_key").alias("imsi"), "resolution_source", *columns)
    invalid = rows.filter("ul_reason IS NOT NULL").select(
        F.lit("invalid-identity-v1").alias("schema_version"), sha256(F.lit("invalid-identity:"), F.col("raw_record_id"), F.lit(":"), F.col("ul_reason")).alias("invalid_identity_id"), "raw_record_id",
        F.col("ul_reason").alias("reason"), F.concat(F.lit("identity not resolved: "), F.col("ul_reason")).alias("error_message"), (failed_at if failed_at is not None else times.now_iso()).alias("failed_at"),
        F.struct(*bronze.columns).alias("original_event"),
    )
    return Routed({"resolved": resolved, "invalid_identity": invalid})


def event_reason(alias: Column, canonical: Column, result: Column, outcome: Column) -> Column:
    """Why an event isn't supported, null if it is: of its normalised id, the catalogue's name for that, its result as given and normalised."""
    return (
        F.when(alias.isNull(), "MISSING_EVENT_ID")
        .when(canonical.isNull(), "UNSUPPORTED_EVENT_ID")
        .when(result.isNull(), "MISSING_EVENT_RESULT")
        .when(outcome.isNull(), "UNSUPPORTED_EVENT_RESULT")
    )


def normalise_events(resolved: DataFrame, catalogue: DataFrame, *, failed_at: Column | None = None) -> Routed:
    """``silver`` events of catalogued kinds, and ``unsupported_event`` records."""
    rows = settle(resolved, ul_alias=text.event_name(F.col("event_id")), ul_result=text.event_outcome(F.col("event_result")))
    rows = rows.join(small(catalogue.withColumnRenamed("alias", "ul_alias")), "ul_alias", "left")
    rows = settle(rows, ul_reason=event_reason(F.col("ul_alias"), F.col("canonical"), F.col("event_result"), F.col("ul_result")))
    id_changed, result_changed = ~F.col("event_id").eqNullSafe(F.col("canonical")), ~F.col("event_result").eqNullSafe(F.col("ul_result"))
    warnings = F.filter(F.array(F.when(id_changed, "EVENT_ID_NORMALIZED"), F.when(result_changed, "EVENT_RESULT_NORMALIZED")), lambda w: w.isNotNull())
    field = lambda name: strip_to_null(F.try_element_at("raw_fields", F.lit(name)))
    silver = rows.filter("ul_reason IS NULL").select(
        F.lit("silver-v1").alias("schema_version"), sha256(F.lit("silver-event:"), F.col("raw_record_id")).alias("silver_event_id"), "raw_record_id", "ue_key", "imsi", F.col("canonical").alias("event_id"),
        F.col("ul_result").alias("event_result"), "duration_ms", "request_retries", field("SUB_TYPE").alias("sub_type"), "event_time", field("REPORT_SIDE").alias("report_side"),
        "msisdn", "mtmsi", "imeisv", "mmegi", "mmec", "tac", "eci", "sgw", field("SGSN").alias("sgsn"),
        F.struct("event_name", F.when(F.col("ul_result") == "", "Empty").otherwise(F.initcap("ul_result")).alias("event_result_label")).alias("display"),
        F.struct(F.col("resolution_source").alias("identity_resolution_source"), id_changed.alias("event_id_changed"), result_changed.alias("event_result_changed"), F.lit(True).alias("event_result_recognized"), warnings.alias("warnings")).alias("quality"),
        "raw_fields", "source",
    )
    unsupported = rows.filter("ul_reason IS NOT NULL").select(
        F.lit("unsupported-event-v1").alias("schema_version"), sha256(F.lit("unsupported-event:"), F.col("raw_record_id"), F.lit(":"), F.col("ul_reason")).alias("unsupported_event_id"), "raw_record_id",
        F.col("ul_reason").alias("reason"), F.concat(F.lit("event not supported: "), F.col("ul_reason")).alias("message"), (failed_at if failed_at is not None else times.now_iso()).alias("failed_at"),
        F.struct(*resolved.columns).alias("original_event"),
    )
    return Routed({"silver": silver, "unsupported_event": unsupported})


def first_by_coordinates(df: DataFrame, keys: tuple[str, ...] = ("source.topic", "source.partition", "source.offset"), order: str | None = None) -> DataFrame:
    """The first row of each key: by ``order``, else by arrival at the source where the rows tell it, else any row."""
    if order is None and "source" in df.columns:
        order = "source.offset"
    whole = F.struct(*df.columns)
    named = [F.col(k).alias(f"ul_{i}") for i, k in enumerate(keys)]
    first = F.first(whole) if order is None else F.min_by(whole, F.struct(F.col(order), *([F.col("raw_record_id")] if "raw_record_id" in df.columns else [])))
    return df.groupBy(*named).agg(first.alias("r")).select("r.*")


def split_late(df: DataFrame, *, ts: str, arrival: list[str], key: list[str], tolerance_ms: int = 30_000, block: Column | None = None) -> Routed:
    """``on_time`` and ``late``: late if before the greatest time so far in its partition less the tolerance; equal is on time.

    ``block``: stretches of the arrival, each a task of its own (:data:`scans.OFFSETS` wide where it isn't given).
    """
    block = scans.default_block(df, arrival[0], scans.OFFSETS) if block is None else block
    rows = scans.seen_before(df, ts, arrival, [F.col(k) for k in key], block, "ul_seen")
    late = F.coalesce(F.col(ts) < F.col("ul_seen") - tolerance_ms, F.lit(False))
    return Routed({"on_time": rows.filter(~late).drop("ul_seen"), "late": rows.filter(late).drop("ul_seen")})
