"""Topics as streams and sinks: folders of Parquet files, or Kafka where its connector is on the class path.

A message has topic, key, JSON value and partition; read back it also has an offset and a broker time.

Folders commit in two phases. All outputs of a micro-batch are one write into a hidden staging folder, which Spark's own protocol makes whole or not at all; then one rename
publishes it under the name of the job and the batch. A failure before the rename leaves nothing to read, one after it leaves the whole batch, and a batch that is
repeated finds its name taken and adds nothing. The rename must be atomic, as in HDFS and on local disks; on a store where it isn't, use Kafka.
"""

from __future__ import annotations

import functools
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from uelumen.schemas import KAFKA_RECORD, TOPICS
from uelumen.sources import ingest

PARTITIONS = 3
#: Offsets of a micro-batch begin at its number times this.
BATCH_OFFSETS = 1 << 40


def check_topics(names: dict[str, tuple[str, str]] = TOPICS) -> None:
    """Every output needs a topic of its own."""
    topics = [t for t, _ in names.values()]
    if len(set(topics)) != len(topics):
        raise ValueError("two outputs share a topic")


Outputs = list[tuple[DataFrame, list[str] | None]]  # messages and, within a partition, their order (default: key)


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


@dataclass(frozen=True)
class FileTransport:
    """``root``/data/commit=JOB-BATCH/topic=NAME/*.parquet in a folder that all executors share."""

    root: str
    partitions: int = PARTITIONS

    @property
    def data(self) -> str:
        return f"{self.root.rstrip('/')}/data"

    def _rows(self, reader, place: str = "") -> DataFrame:
        schema = "key string, `partition` int, `offset` long, kafka_timestamp long, value string, commit string, topic string"
        return reader.schema(schema).option("basePath", self.data).parquet(f"{self.data}{place}")

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        """All committed messages of a topic so far."""
        fs, path = _fs(spark, self.data)
        fs.mkdirs(path)
        return self._rows(spark.read).filter(F.col("topic") == topic).select("key", *self._columns())

    def stream(self, spark: SparkSession, topic: str, *, start: str = "earliest") -> DataFrame:
        """New messages; a checkpoint goes on where it was. ``latest`` leaves out what lies there when a new query starts."""
        ingest.check_start(start)
        fs, path = _fs(spark, self.data)
        fs.mkdirs(path)
        rows = self._rows(spark.readStream, f"/commit=*/topic={topic}")
        if start == "latest":
            now = spark.sql("SELECT unix_millis(current_timestamp())").first()[0]
            rows = rows.filter(F.col("kafka_timestamp") >= now)
        return rows.select(*self._columns())

    @staticmethod
    def _columns() -> list[str]:
        return ["topic", "partition", "offset", "kafka_timestamp", "value"]

    def _placed(self, messages: DataFrame, batch_id: int, order: list[str] | None) -> DataFrame:
        given = F.col("partition") if "partition" in messages.columns else F.pmod(F.xxhash64("key"), F.lit(self.partitions))
        rows = messages.withColumn("partition", given.cast("int"))
        place = F.row_number().over(Window.partitionBy("topic", "partition").orderBy(*(order or ["key"])))
        rows = rows.withColumn("offset", F.lit(batch_id * BATCH_OFFSETS).cast("long") + place).withColumn("kafka_timestamp", F.unix_millis(F.current_timestamp()))
        return rows.select("key", *self._columns())

    def commit(self, outputs: Outputs, batch_id: int, job: str) -> dict[str, int]:
        """Publish all outputs of a batch at once; how many messages each topic has of it."""
        spark = outputs[0][0].sparkSession
        name = f"commit={job}-{batch_id}"
        fs, target = _fs(spark, f"{self.data}/{name}")
        if not fs.exists(target):
            staging = f"{self.root.rstrip('/')}/_staging/{name}-{uuid.uuid4().hex}"
            rows = functools.reduce(DataFrame.unionByName, [self._placed(m, batch_id, order) for m, order in outputs])
            rows.write.partitionBy("topic").parquet(staging)
            fs.mkdirs(target.getParent())
            self._publish(fs, _fs(spark, staging)[1], target)
        held = spark.read.schema("key string, topic string").parquet(f"{self.data}/{name}")
        return {r.topic: r.n for r in held.groupBy("topic").agg(F.count("*").alias("n")).collect()}

    @staticmethod
    def _publish(fs, staging, target) -> None:
        """The commit. Where another attempt was first, what this one has staged is given up."""
        if not fs.rename(staging, target):
            if not fs.exists(target):
                raise OSError(f"{staging} could not be published as {target}")
            fs.delete(staging, True)

    def clear_staging(self, spark: SparkSession) -> None:
        """Delete what failed attempts have left; call it while no job is at work."""
        fs, path = _fs(spark, f"{self.root.rstrip('/')}/_staging")
        fs.delete(path, True)


@dataclass(frozen=True)
class KafkaTransport:
    """A broker. Spark's Kafka sink is at-least-once; consumers tell repeated records by their ids."""

    servers: str

    def stream(self, spark: SparkSession, topic: str, *, start: str = "earliest") -> DataFrame:
        return ingest.kafka_stream(spark, self.servers, topic, start=start)

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        rows = spark.read.format("kafka").options(**ingest.kafka_source_options(self.servers, topic, "earliest")).load()
        return rows.select(F.col("key").cast("string").alias("key"), *ingest.kafka_columns())

    def commit(self, outputs: Outputs, batch_id: int, job: str) -> dict[str, int]:
        """Send all outputs of a batch, one after the other; how many messages each topic has been sent."""
        sent: dict[str, int] = {}
        for messages, _ in outputs:
            names = ["topic", "key", "value", *(["partition"] if "partition" in messages.columns else [])]
            messages = messages.select(names).persist()
            try:
                sent |= {r.topic: r.n for r in messages.groupBy("topic").agg(F.count("*").alias("n")).collect()}
                messages.write.format("kafka").options(**ingest.kafka_sink_options(self.servers)).save()
            finally:
                messages.unpersist()
        return sent
