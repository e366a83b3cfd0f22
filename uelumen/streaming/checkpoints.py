"""What a checkpoint of a stateful query holds: its state as tables, and whether a changed query may go on from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType, _parse_datatype_string

from uelumen.contract import ContractError


def state(spark: SparkSession, checkpoint: str, variable: str, *, batch: int | None = None, operator: int = 0) -> DataFrame:
    """A state variable after the last batch, or after ``batch``: its keys, its value and, where it has a TTL, when it expires."""
    reader = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator).option("stateVarName", variable)
    return (reader if batch is None else reader.option("batchId", batch)).load()


def _held(rows: DataFrame) -> DataType:
    """The type of a value as a query declares it, without the wrapper for the expiry."""
    for name in ("value", "user_map_value", "map_value", "list_element", "list_value"):
        if name in rows.columns:
            kind = rows.schema[name].dataType
            return kind["value"].dataType if isinstance(kind, StructType) and "ttlExpirationMs" in kind.names else kind
    raise ContractError(f"no value among {rows.columns}")


def _names(kind: DataType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in kind.fields] if isinstance(kind, StructType) else [("", kind.simpleString())]


def check(spark: SparkSession, checkpoint: str, declared: dict[str, str], *, operator: int = 0) -> None:
    """Refuse a query whose state variables (name, DDL of the value) differ from those that the checkpoint holds."""
    for variable, ddl in declared.items():
        try:
            held = _names(_held(state(spark, checkpoint, variable, operator=operator)))
        except ContractError:
            raise
        except Exception as e:
            raise ContractError(f"{checkpoint} holds no state {variable}") from e
        want = _names(_parse_datatype_string(ddl))
        if held != want:
            raise ContractError(f"state {variable} of {checkpoint} holds {held}, not {want}")


def expiry(rows: DataFrame) -> Column:
    """When a value expires, in epoch milliseconds."""
    for name in ("value", "user_map_value", "map_value", "list_element", "list_value"):
        if name in rows.columns and isinstance(rows.schema[name].dataType, StructType) and "ttlExpirationMs" in rows.schema[name].dataType.names:
            return F.col(f"{name}.ttlExpirationMs")
    return F.lit(None).cast("long")
