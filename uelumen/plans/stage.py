"""Staged tables: a result that several queries read is written once to the cluster's shared folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JError, Py4JNetworkError
from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset a temporary folder, which only a local run can share between its tasks."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="uelumen-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder; nothing happens if the session has ended."""
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except (Py4JError, Py4JNetworkError, OSError, AttributeError):
        pass  # the folder goes with the cluster's


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder. Deleted when the driver ends."""
    path = f"{scratch_root(spark)}/uelumen-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return f"{path}/{label}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet and read back: evaluated once, and an executor lost later costs a re-read. Deleted when the driver ends."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def _release() -> None:
    while _written:
        delete(*_written.pop())
