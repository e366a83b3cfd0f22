"""Settings and lookup tables from YAML or JSON files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from uelumen.contract import ContractError
from uelumen.operators import silver
from uelumen.plans.layers import Dimensions


def read(path: str) -> dict:
    """A mapping from a file; an error if it holds anything else."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        raw = json.loads(text)
    else:
        import yaml

        raw = yaml.safe_load(text)
    if not isinstance(raw, dict):
        raise ContractError(f"{path}: not a mapping")
    return raw


def identity(spark: SparkSession, kind: str, mapping: dict | None) -> DataFrame:
    """The dimension of a mapping alias -> IMSI; keys and values may be numbers in the file."""
    rows = [(str(k), str(v)) for k, v in (mapping or {}).items()]
    return silver.identity_dimension(spark.createDataFrame(rows, f"{kind} string, imsi string"), kind)


def catalogue(spark: SparkSession, entries: dict | None) -> DataFrame:
    """Event catalogue of canonical id -> {name, aliases}; without one the built-in events."""
    if not entries:
        return silver.event_catalogue(spark)
    rows = []
    for canonical, entry in entries.items():
        name = (entry or {}).get("name")
        if not name:
            raise ContractError(f"event {canonical}: a name is missing")
        rows += [(alias, canonical, name) for alias in dict.fromkeys([canonical, *entry.get("aliases", [])])]
    return silver.event_catalogue(spark, rows)


def dimensions(spark: SparkSession, raw: dict) -> Dimensions:
    """``identity.msisdn``, ``identity.mtmsi`` and ``events`` of a settings file."""
    given = raw.get("identity") or {}
    if unknown := set(given) - {"msisdn", "mtmsi"}:
        raise ContractError("unknown identity mappings: " + ", ".join(sorted(unknown)))
    return Dimensions(identity(spark, "msisdn", given.get("msisdn")), identity(spark, "mtmsi", given.get("mtmsi")), catalogue(spark, raw.get("events")))


def settings(raw: dict, **overrides):
    """Job settings of ``job``, with overrides; unknown names are errors."""
    from dataclasses import fields

    from uelumen.streaming.jobs import Settings

    merged = {**(raw.get("job") or {}), **{k: v for k, v in overrides.items() if v is not None}}
    if unknown := set(merged) - {f.name for f in fields(Settings)}:
        raise ContractError("unknown job settings: " + ", ".join(sorted(unknown)))
    if not merged.get("checkpoints"):
        raise ContractError("job.checkpoints is missing")
    return Settings(**merged)
