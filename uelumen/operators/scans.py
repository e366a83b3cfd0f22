"""Ordered scans in blocks: running maxima, row numbers and runs of a key without one task for the key.

A *block* is a stretch of a key's order: so many offsets, or so long a time. Every function does the work of a block in a task of its own, makes one small row of
each block, scans those rows in order of the blocks, and joins what came before each block back to its rows. Rows are dealt by (key, block) once; the join and the
local scan share that partitioning. A key with all rows of a table is spread over as many tasks as it has blocks.

Null in the block's column is a block of its own, before all others, as nulls come first in an ascending order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OFFSETS = 65_536
HOUR_MS = 3_600_000


def block_of(column: str, size: int) -> Column:
    """The block of a number: ``size`` wide, monotone, null before all others."""
    return F.floor(F.col(column) / F.lit(size)).cast("long")


def default_block(df: DataFrame, column: str, size: int) -> Column:
    """Blocks of whatever orders a key: ``size`` wide where it is a number, else its first 13 characters (the hour of an ISO time), which are monotone as well."""
    kind = df.select(F.col(column).alias("c")).schema["c"].dataType
    if isinstance(kind, T.NumericType):
        return block_of(column, size)
    return F.substring(column, 1, 13) if isinstance(kind, T.StringType) else F.lit(0).cast("long")


def _before(blocks: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Each block with an aggregate over the blocks of its key that come before it."""
    earlier = Window.partitionBy(*keys).orderBy(F.col("ul_block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(*keys, "ul_block", value.over(earlier).alias("ul_before"))


def _join(rows: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    right = blocks.select(*[F.col(k).alias(f"ul_r_{i}") for i, k in enumerate(keys)], F.col("ul_block").alias("ul_r_block"), "ul_before")
    on = F.col("ul_block").eqNullSafe(F.col("ul_r_block"))
    for i, k in enumerate(keys):
        on &= F.col(k).eqNullSafe(F.col(f"ul_r_{i}"))
    return rows.join(right, on, "left").drop("ul_r_block", *[f"ul_r_{i}" for i in range(len(keys))])


def seen_before(df: DataFrame, value: str, order: list[str], keys: list[Column], block: Column, name: str) -> DataFrame:
    """``df`` with the greatest ``value`` of its key in rows before it, null where there is none: a prefix maximum on two levels."""
    named = [f"ul_k_{i}" for i in range(len(keys))]
    rows = df.select("*", *[k.alias(n) for k, n in zip(keys, named)], block.alias("ul_block"))
    own = Window.partitionBy(*named, "ul_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*named, "ul_block").agg(F.max(value).alias("ul_top"))
    joined = _join(rows.withColumn("ul_own", F.max(value).over(own)), _before(blocks, named, F.max("ul_top")), named)
    return joined.withColumn(name, F.greatest("ul_own", "ul_before")).drop("ul_own", "ul_before", "ul_block", *named)


def numbered(df: DataFrame, keys: list[str], order: list[str], block: Column, name: str) -> DataFrame:
    """``df`` with the number of each row within its key, from 0: prefix sums of the counts of blocks."""
    rows = df.withColumn("ul_block", block)
    blocks = rows.groupBy(*keys, "ul_block").agg(F.count("*").alias("ul_n"))
    own = rows.withColumn("ul_own", F.row_number().over(Window.partitionBy(*keys, "ul_block").orderBy(*order)))
    joined = _join(own, _before(blocks, keys, F.sum("ul_n")), keys)
    return joined.withColumn(name, F.col("ul_own") - 1 + F.coalesce("ul_before", F.lit(0))).drop("ul_own", "ul_before", "ul_block")


# Summaries of runs: n rows, the run that begins them, the run that ends them, the longest run. They merge in order, however they are grouped.


def one_run(hit: Column) -> Column:
    """The summary of a single row."""
    own = hit.cast("long")
    return F.struct(F.lit(1).cast("long").alias("n"), own.alias("prefix"), own.alias("suffix"), own.alias("best"))


def merge_runs(a: Column, b: Column) -> Column:
    """The summary of what ``a`` tells of, followed by what ``b`` tells of."""
    return F.struct(
        (a["n"] + b["n"]).alias("n"), F.when(a["prefix"] == a["n"], a["n"] + b["prefix"]).otherwise(a["prefix"]).alias("prefix"),
        F.when(b["suffix"] == b["n"], b["n"] + a["suffix"]).otherwise(b["suffix"]).alias("suffix"), F.greatest(a["best"], b["best"], a["suffix"] + b["prefix"]).alias("best"),
    )


def _fold(items: Column, summary: str) -> Column:
    """Merge an array of (order, summary) structs, sorted by order."""
    nothing = F.struct(*[F.lit(0).cast("long").alias(x) for x in ("n", "prefix", "suffix", "best")])
    return F.aggregate(F.array_sort(items), nothing, lambda a, x: merge_runs(a, x[summary]))


def block_runs(df: DataFrame, key: str, order: list[str], hit: Column, block: Column) -> DataFrame:
    """(key, ul_block, runs): the summary of each block of a key."""
    rows = df.select(key, block.alias("ul_block"), F.struct(*order, one_run(hit).alias("s")).alias("ul_x"))
    return rows.groupBy(key, "ul_block").agg(_fold(F.collect_list("ul_x"), "s").alias("runs"))


def merge_blocks(runs: DataFrame, key: str, fan: int | None = None) -> DataFrame:
    """Summaries of ``fan`` blocks in a row merged into one, under the number of the wider block; without ``fan`` all blocks of a key."""
    wider = F.lit(0).cast("long") if fan is None else F.floor(F.col("ul_block") / fan).cast("long")  # with a fan, blocks are numbers
    grouped = runs.groupBy(key, wider.alias("ul_wide")).agg(_fold(F.collect_list(F.struct("ul_block", "runs")), "runs").alias("runs"))
    return grouped.withColumnRenamed("ul_wide", "ul_block")
