"""Record schemas as DDL."""

from __future__ import annotations

KAFKA_RECORD = "topic string, `partition` int, `offset` long, kafka_timestamp long, value string"
ENVELOPE = "schema_version string, raw_record_id string, source_file string, source_line string, raw_payload string"
SOURCE = "struct<source_file:string,source_line:bigint,topic:string,partition:int,offset:bigint,kafka_timestamp:string,ingest_time:string>"
BRONZE = (
    "schema_version string, raw_record_id string, event_id string, event_result string, duration_ms long, request_retries int, paging_attempts int, event_time string, "
    "event_time_quality string, msisdn string, imsi string, mtmsi string, imeisv string, mmegi string, mmec string, sub_cause_code string, msc string, tac string, eci string, "
    f"sgw string, pdn_pgw string, raw_fields map<string,string>, source {SOURCE}"
)
SILVER = (
    "schema_version string, silver_event_id string, raw_record_id string, ue_key string, imsi string, event_id string, event_result string, duration_ms long, request_retries int, "
    "sub_type string, event_time string, report_side string, msisdn string, mtmsi string, imeisv string, mmegi string, mmec string, tac string, eci string, sgw string, sgsn string, "
    "display struct<event_name:string,event_result_label:string>, quality struct<identity_resolution_source:string,event_id_changed:boolean,event_result_changed:boolean,"
    f"event_result_recognized:boolean,warnings:array<string>>, raw_fields map<string,string>, source {SOURCE}"
)
GOLD_EVENT = (
    "ue_key string, imsi string, event_id string, event_result string, normalized_cause_code string, sub_cause_code string, duration_ms long, request_retries int, event_code int, "
    "event_result_code int, event_time_epoch_ms long, feature_source_fields map<string,string>, display_fields map<string,string>, quality_fields map<string,string>, source_order_key string"
)
GOLD_INPUT = GOLD_EVENT
GOLD = (
    "schema_version string, feature_version string, sample_id string, ue_key string, imsi string, window_start_event_time string, window_end_event_time string, sequence_length int, stride int, "
    f"model_input struct<x_cat:array<array<bigint>>,x_num:array<array<float>>>, evidence struct<events:array<struct<{GOLD_EVENT.replace(' ', ':').replace(',:', ',').replace(':long', ':bigint')}>>>"
)
# Topics and their key columns.
TOPICS = {
    "raw": ("raw.ue.log.line", "raw_record_id"),
    "bronze": ("bronze.ue.event", "raw_record_id"),
    "bronze_dlq": ("dlq.ue.log.line", "dlq_id"),
    "silver": ("silver.ue.event", "ue_key"),
    "silver_late": ("late-ue-event", "ue_key"),
    "invalid_identity": ("invalid-identity", "invalid_identity_id"),
    "unsupported_event": ("unsupported-event", "unsupported_event_id"),
    "gold": ("gold.ue.sequence", "ue_key"),
    "too_late": ("gold-too-late-event", "ue_key"),
    "invalid_feature": ("invalid-gold-feature", "ue_key"),
    "predictions": ("anomaly-predictions", "ue_key"),
}
