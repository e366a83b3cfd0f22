"""Whole layers: raw records to Bronze, Silver, Gold and predictions, in batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from uelumen.contract import Contract
from uelumen.functions.times import epoch_millis
from uelumen.operators import bronze, scans, sequences, silver
from uelumen.operators.routes import Routed
from uelumen.plans.stage import stage


@dataclass
class Dimensions:
    by_msisdn: DataFrame
    by_mtmsi: DataFrame
    catalogue: DataFrame


def bronze_layer(records: DataFrame, *, clock: Column | None = None, **options) -> Routed:
    return bronze.bronze(records, ingest_time=clock, **options)


def silver_layer(events: DataFrame, dims: Dimensions, *, clock: Column | None = None, arrival: tuple[str, ...] = ("source.offset",), tolerance_ms: int = 30_000) -> Routed:
    """silver, late, invalid_identity, unsupported_event. Lateness is by partition of a source topic, in offset order, by blocks of offsets.

    Events that passed identity, catalogue and the check for duplicates are staged: both their routes and both passes over them read that table.
    """
    resolved = silver.resolve_identity(events, dims.by_msisdn, dims.by_mtmsi, failed_at=clock)
    known = silver.normalise_events(resolved["resolved"], dims.catalogue, failed_at=clock)
    unique = silver.first_by_coordinates(known["silver"])
    timed = stage(unique.withColumn("ul_ms", epoch_millis(unique["event_time"])), "unique")
    late = silver.split_late(timed, ts="ul_ms", arrival=list(arrival), key=["source.topic", "source.partition"], tolerance_ms=tolerance_ms)
    return Routed({"silver": late["on_time"].drop("ul_ms"), "late": late["late"].drop("ul_ms"), "invalid_identity": resolved["invalid_identity"], "unsupported_event": known["unsupported_event"]})


def gold_layer(events: DataFrame, contract: Contract | None = None, *, clock: Column | None = None, tolerance_ms: int = sequences.TOLERANCE_MS) -> Routed:
    """gold, too_late, invalid_feature. Arrival is offset order where the events carry it.

    The mapped events are staged, read in blocks of offsets for lateness and in hours for the windows, so that no subscriber is one task's.
    """
    mapped = stage(sequences.to_gold_events(events.withColumn("ul_offset", events["source.offset"]), contract, carry=["ul_offset"]), "mapped")
    split = sequences.split_too_late(mapped, arrival=["ul_offset"], tolerance_ms=tolerance_ms)
    made = sequences.gold_samples(split["accepted"].drop("ul_offset"), contract, failed_at=clock, block=scans.block_of("event_time_epoch_ms", scans.HOUR_MS))
    return Routed({"gold": made["gold"], "too_late": split["too_late"].drop("ul_offset"), "invalid_feature": made["invalid_feature"]})
