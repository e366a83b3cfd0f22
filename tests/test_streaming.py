"""The streaming sequence operator gives what the batch formulation gives."""

import time

import pytest
from pyspark.sql import functions as F

from uelumen.operators import sequences
from uelumen.streaming import processors

SCHEMA = "ue_key string, event_time_epoch_ms long, source_order_key string"


@pytest.mark.parametrize("n, expected", [(41, 2)])
def test_smoke_scenario(spark, tmp_path, n, expected):
    """40 events a second apart and one 30 s later: two windows before any idle flush, none after."""
    rows = [("u", i * 1000, f"{i:03d}") for i in range(n - 1)] + [("u", 70_000, "999")]
    df = spark.createDataFrame(rows, SCHEMA)
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    processors.use_rocksdb(spark)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    made = processors.sequence_stream(stream, idle_ms=1000)
    query = made.writeStream.format("memory").queryName("sequences").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(processingTime="1 second").start()
    try:
        end = time.time() + 90
        while time.time() < end and query.isActive and spark.table("sequences").count() < expected * 32:
            time.sleep(1)
        time.sleep(3)  # the idle flush may add nothing
    finally:
        query.stop()
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    got = spark.table("sequences")
    assert got.filter("route = 'too_late'").count() == 0
    streamed = got.filter("route = 'window'").groupBy("window_no").agg(F.array_sort(F.collect_list("source_order_key")).alias("o"))
    batch = sequences.windows(df).select("window_no", F.transform("events", lambda e: e["source_order_key"]).alias("o"))
    assert sorted((r.window_no, list(r.o)) for r in streamed.collect()) == sorted((r.window_no, list(r.o)) for r in batch.collect())
    assert streamed.count() == expected
