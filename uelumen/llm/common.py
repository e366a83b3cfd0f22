"""Shared pieces of the training-data operators: scratch tables, Arrow batch loops, input wrapping."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uelumen.plans.stage import delete, scratch_root

PART_BYTES = 4 << 20
BATCH_BYTES = "8m"

_written: dict[str, tuple[SparkSession, str]] = {}
_scope = [""]


@contextlib.contextmanager
def scope(name: str, spark: SparkSession) -> Iterator[None]:
    """Stage tables written inside belong to ``name``; those that an earlier use of the name has left are deleted first."""
    release_stage_tables(name)
    forget_shuffles(spark)
    _scope.append(name)
    try:
        yield
    finally:
        _scope.pop()


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that nothing refers to any more; it does so when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stage_table(df: DataFrame, label: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    It cuts the lineage: an executor lost later costs only a re-read. The folder is deleted when the
    driver ends, or by :func:`release_stage_tables`.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/uelumen-{uuid.uuid4().hex}/{label}"
    _written[path] = spark, _scope[-1]
    writer = df.write
    if keys := list(partition_by):
        writer = writer.partitionBy(*keys)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, deleted with the stage tables."""
    path = f"{scratch_root(spark)}/uelumen-{uuid.uuid4().hex}/{label}"
    _written[path] = spark, _scope[-1]
    return path


def release_stage_tables(name: str | None = None) -> None:
    """Delete every stage table written so far, or those of a scope; call it once nothing reads them any more."""
    for path, (spark, own) in list(_written.items()):
        if name is not None and own != name:
            continue
        del _written[path]
        delete(spark, path.rsplit("/", 1)[0])


atexit.register(release_stage_tables)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each value, empty for null, without decoding to str."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def text_values(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about ``PART_BYTES`` (a longer row is a part of its own)."""
    rows = max(1, batch.num_rows * PART_BYTES // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        if part.num_rows == 1 or part.nbytes <= 2 * PART_BYTES:
            yield part
        else:
            yield from (x for half in (part.slice(0, part.num_rows // 2), part.slice(part.num_rows // 2)) for x in slices(half))


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` (or one row), unless the session sets a bound of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, BATCH_BYTES)


def _trim() -> None:
    """Give freed memory back, so that what one kind of task needed isn't held by a worker while it runs others."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow whose worker gives memory back as its task ends."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _trim()

    return whole


def map_texts(df: DataFrame, kernel: Callable[[pa.RecordBatch], dict], schema: str, *, after: Callable[[], None] | None = None) -> DataFrame:
    """mapInArrow where ``kernel`` makes the columns of one output batch from some ``PART_BYTES`` of input; ``after`` runs as the task ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part in slices(batch):
                    yield pa.RecordBatch.from_pydict(kernel(part))
        finally:
            if after is not None:
                after()

    bound_batches(df.sparkSession)
    return df.mapInArrow(trimmed(run), schema)


def whole_row(df: DataFrame, **extra) -> DataFrame:
    """The input row as one struct ``ul_row``, with ``extra`` columns beside it.

    Columns of the input then can't clash with those an operator adds.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("ul_row"), *[c.alias(k) for k, c in extra.items()])
