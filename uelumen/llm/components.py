"""Connected components of an edge table by alternating large-star and small-star rounds.

Every step is a grouped minimum (combined before the shuffle) and a join, so no group is ever gathered in one task.
Each round ends with the stars of what every task holds, and is written to the shared folder, which cuts the lineage; the rounds end when the edges are stars. The number of rounds grows with the logarithm of the
longest path.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uelumen.llm.common import stage_table, trimmed

CHUNK = 100_000


def local_stars(pairs: Iterator[tuple[int, int]]) -> dict[int, int]:
    """node -> smallest node that the given pairs reach, for every node of a pair."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    for a, b in pairs:
        if (a := root(a)) != (b := root(b)):
            up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


def contract(edges: DataFrame) -> DataFrame:
    """The same components with the edges of each ``CHUNK`` rows of a task replaced by stars."""

    def run(batches):
        held: list[pa.RecordBatch] = []

        def star() -> pa.RecordBatch:
            found = local_stars(pair for batch in held for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            got = [(x, r) for x, r in found.items() if x != r]
            held.clear()
            return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in got], pa.int64()), "b": pa.array([r for _, r in got], pa.int64())})

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK:
                yield star()
        if held:
            yield star()

    return edges.mapInArrow(trimmed(run), "a long, b long")


def _settled(edges: DataFrame) -> bool:
    """Whether the edges (a, b) are stars: each a has one b, and no b is an a."""
    ends = edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a").union(edges.select("a").join(edges.select(F.col("b").alias("a")), "a", "left_semi"))
    return ends.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b: long); root is the component's smallest node."""
    edges = stage_table(contract(edges).distinct(), "edges")
    while not _settled(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        edges = stage_table(contract(small.distinct()).distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
