"""Main and side outputs: one tagged frame, split by route."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns that are evaluated once: filters and projections above are not merged into them.

    Catalyst pushes a filter below the projection that defines its column by copying the definition; for a chain of large
    definitions the copies multiply. It does not push through a generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


@dataclass
class Routed:
    """The outputs of a stage by name; ``main`` is the first."""

    outputs: dict[str, DataFrame]

    def __getitem__(self, name: str) -> DataFrame:
        return self.outputs[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.outputs)

    def counts(self) -> DataFrame:
        """(route, n) of every output, the empty ones too."""
        parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("route"), "n") for name, df in self.outputs.items()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def write_routes(tagged: DataFrame, batch_id: int, paths: dict[str, str], column: str = "route") -> None:
    """For foreachBatch: each route of a micro-batch to its own folder, named by the batch so that a repeat overwrites it."""
    tagged.persist()
    try:
        for route, path in paths.items():
            tagged.filter(F.col(column) == route).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    finally:
        tagged.unpersist()
