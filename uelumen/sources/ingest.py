"""Log directories to raw envelopes, and the transports between layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, _parse_datatype_string

from uelumen.functions.text import sha256

ENVELOPE_VERSION = "raw-envelope-v1"


def list_files(spark: SparkSession, directory: str) -> list[str]:
    """Regular files of a directory, not of its sub-directories, by path; an error if there are none."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
        raise ValueError(f"not a directory: {directory}")
    files = sorted(s.getPath().toString() for s in fs.listStatus(path) if s.isFile())
    if not files:
        raise ValueError(f"no files in {directory}")
    return files


RANGE_BYTES = 64 << 20


def read_lines(spark: SparkSession, directory: str, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(source_file, source_line, raw_payload) of the regular files of a directory; see :func:`number_lines`."""
    return number_lines(spark, list_files(spark, directory), range_bytes=range_bytes).drop("path")


def number_lines(spark: SparkSession, files: list[str], *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(source_file, source_line, raw_payload, path): file name without directory, lines from 1, ended by LF, CR or CRLF; the end of a file ends a line that isn't empty.

    Files are read by ranges of ``range_bytes``, each a task's work. One pass counts the lines of each range (without their text), the counts of the ranges before one are its offset,
    a second pass reads the lines and numbers them: a range's lines lie one after the other in a partition. Both passes must see the same ranges, so they run in a session of
    their own whose ranges don't depend on how many executors there are at the time. A byte order mark at the beginning of a file is dropped.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    for name, value in (("spark.sql.files.maxPartitionBytes", range_bytes), ("spark.sql.leafNodeDefaultParallelism", 1), ("spark.sql.files.minPartitionNum", 1)):
        own.conf.set(name, str(value))
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")]
    lines = own.read.text(files).select(*place, F.col("_metadata.file_name").alias("source_file"), F.col("value").alias("raw_payload"), F.monotonically_increasing_id().alias("id"))
    ranges = lines.groupBy("path", "start").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ranges.select("path", "start", (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("ahead"))
    # a row for each range: adaptive execution broadcasts them where they are few
    return lines.join(offsets, ["path", "start"]).select("source_file", (F.col("id") + F.col("ahead")).alias("source_line"), "raw_payload", "path")


def record_id(file: Column, line: Column, payload: Column) -> Column:
    return sha256(file, F.lit(":"), line.cast("string"), F.lit(":"), payload)


def envelopes(lines: DataFrame) -> DataFrame:
    """Raw envelopes of lines; the payload may be empty."""
    return lines.select(
        F.lit(ENVELOPE_VERSION).alias("schema_version"),
        record_id(F.col("source_file"), F.col("source_line"), F.col("raw_payload")).alias("raw_record_id"),
        "source_file", "source_line", "raw_payload",
    )


def to_messages(df: DataFrame, topic: str, key: str, partition: Column | None = None, carry: DataFrame | None = None) -> DataFrame:
    """(topic, key, value[, partition]) with a JSON value; a blank key or a negative partition is an error.

    ``carry``: ``df`` with further columns, which come beside the message but not in its value.
    """
    k = F.trim(F.col(key))
    checked = F.when(k.isNull() | (k == ""), F.raise_error(F.lit(f"blank key {key}"))).otherwise(k)
    out = [F.lit(topic).alias("topic"), checked.alias("key"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")]
    if partition is not None:
        out.append(F.when(partition < 0, F.raise_error(F.lit("negative partition"))).otherwise(partition).cast("int").alias("partition"))
    return df.select(*out) if carry is None else carry.select(*out, *carry.columns[len(df.columns) :])


def as_kafka_records(messages: DataFrame, topic: str, partitions: int = 3) -> DataFrame:
    """Messages with the coordinates a broker would give, for a run without one: partition by key, offset by value order."""
    part = F.pmod(F.hash("key"), F.lit(partitions)).cast("int")
    return messages.select(F.lit(topic).alias("topic"), part.alias("partition"), F.monotonically_increasing_id().alias("offset"), F.unix_millis(F.current_timestamp()).alias("kafka_timestamp"), "value")


def check_start(start: str) -> None:
    if start not in ("earliest", "latest"):
        raise ValueError(f"starting offsets must be earliest or latest, not {start}")


def kafka_source_options(servers: str, topic: str, start: str) -> dict[str, str]:
    """Committed records only. ``startingOffsets`` holds for a new query; a checkpoint goes on from its committed offsets."""
    check_start(start)
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start, "kafka.isolation.level": "read_committed", "kafka.default.api.timeout.ms": "180000", "kafka.request.timeout.ms": "60000"}


def kafka_columns() -> list[Column]:
    return [F.col("topic"), F.col("partition"), F.col("offset"), F.unix_millis("timestamp").alias("kafka_timestamp"), F.col("value").cast("string").alias("value")]


def kafka_stream(spark: SparkSession, servers: str, topic: str, *, start: str = "earliest") -> DataFrame:
    """A Kafka topic as raw records, null values kept. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_source_options(servers, topic, start)).load().select(*kafka_columns())


def kafka_sink_options(servers: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "kafka.acks": "all", "kafka.enable.idempotence": "true", "kafka.retries": "2147483647", "kafka.compression.type": "lz4", "kafka.linger.ms": "10", "kafka.batch.size": "65536"}


def unknown_fields(text: Column, kind: DataType, path: str = "") -> Column:
    """Paths of the fields of a JSON text that a schema doesn't name, at every level: within structs, arrays and the values of maps."""
    nothing = F.array().cast("array<string>")
    inner = lambda items, own, at: F.flatten(F.coalesce(F.transform(items, lambda x: unknown_fields(x, own, at)), F.array(nothing)))
    nested = (StructType, ArrayType, MapType)
    if isinstance(kind, StructType):
        own = F.array_except(F.coalesce(F.json_object_keys(text), nothing), F.array(*[F.lit(f.name) for f in kind.fields]))
        found = [F.transform(own, lambda k: F.concat(F.lit(path), k))]
        found += [unknown_fields(F.get_json_object(text, f"$['{f.name}']"), f.dataType, f"{path}{f.name}.") for f in kind.fields if isinstance(f.dataType, nested)]
        return F.concat(*found)
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, nested):
        return inner(F.from_json(text, "array<string>"), kind.elementType, f"{path[:-1]}[].")
    if isinstance(kind, MapType) and isinstance(kind.valueType, nested):
        return inner(F.map_values(F.from_json(text, "map<string,string>")), kind.valueType, f"{path}*.")
    return nothing


def json_fault(text: Column, ddl: str) -> Column:
    """What a strict reader rejects before it looks at types: an empty value, text that is no JSON object, an unknown field at any level; else null."""
    unknown = unknown_fields(text, _parse_datatype_string(ddl))
    return (
        F.when(text.isNull() | (text == ""), F.lit("empty value"))
        .when(F.json_object_keys(text).isNull(), F.lit("not a JSON object"))
        .when(F.size(unknown) > 0, F.concat(F.lit("unknown fields: "), F.array_join(unknown, ",")))
    )


def strict_json(df: DataFrame, ddl: str, value: str = "value", carry: tuple[str, ...] = ()) -> DataFrame:
    """Typed records of JSON text, with the columns ``carry`` beside; what :func:`json_fault` tells of fails the job."""
    fault = json_fault(F.col(value), ddl)
    parsed = F.from_json(F.col(value), ddl, {"mode": "FAILFAST"})
    return df.select(F.when(fault.isNotNull(), F.raise_error(fault)).otherwise(parsed).alias("r"), *carry).select("r.*", *carry)
