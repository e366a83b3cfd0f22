"""Command line: ``python -m uelumen.cli bronze|silver|gold|score IN OUT`` runs a layer in batch on Parquet folders.

``produce DIR OUT`` turns a directory of log files into raw records.

``publish DIR ROOT`` publishes such a directory to topics, ``stream JOB ROOT`` runs a streaming job (bronze, silver, gold, score) on topics under a
folder ROOT, or on a broker ``kafka://servers``, until it is stopped; ``--once`` ends it when everything is handled. ``--settings FILE`` names
identity maps, event catalogue and job settings. ``probe ROOT`` prints the first sound Gold sequence.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from uelumen.operators import scoring, silver
from uelumen.operators.routes import Routed
from uelumen.plans import layers
from uelumen.schemas import TOPICS
from uelumen.sources import ingest


def write(routed: Routed, out: str) -> None:
    for name in routed:
        routed[name].write.mode("overwrite").parquet(f"{out}/{name}")


def produce(spark: SparkSession, directory: str, out: str) -> int:
    """Raw records of a directory; the number written must be the number read."""
    made = ingest.envelopes(ingest.read_lines(spark, directory))
    messages = ingest.to_messages(made, TOPICS["raw"][0], "raw_record_id")
    ingest.as_kafka_records(messages, TOPICS["raw"][0]).write.mode("overwrite").parquet(out)
    written = spark.read.parquet(out).count()
    if written != made.count():
        raise RuntimeError("not every line was published")
    return written


def run(spark: SparkSession, layer: str, source: str, out: str, msisdn: DataFrame | None = None, mtmsi: DataFrame | None = None) -> None:
    if layer == "produce":
        produce(spark, source, out)
        return
    rows = spark.read.parquet(source)
    if layer == "bronze":
        write(layers.bronze_layer(rows), out)
    elif layer == "silver":
        empty = lambda k: spark.createDataFrame([], f"{k} string, imsi string")
        dims = layers.Dimensions(silver.identity_dimension(msisdn if msisdn is not None else empty("msisdn"), "msisdn"), silver.identity_dimension(mtmsi if mtmsi is not None else empty("mtmsi"), "mtmsi"), silver.event_catalogue(spark))
        write(layers.silver_layer(rows, dims), out)
    elif layer == "gold":
        write(layers.gold_layer(rows), out)
    else:
        scoring.predictions(rows, [scoring.calibrate(rows)]).write.mode("overwrite").parquet(out)


def transport_of(root: str):
    from uelumen.streaming import transport

    return transport.KafkaTransport(root.removeprefix("kafka://")) if root.startswith("kafka://") else transport.FileTransport(root)


def stream(spark: SparkSession, job: str, root: str, settings_file: str | None, checkpoints: str | None, once: bool, reference: str | None = None) -> None:
    """Run a streaming job to its end. ``reference``: Gold samples as Parquet that the stand-in model is calibrated on."""
    from uelumen import config
    from uelumen.streaming import jobs

    raw = config.read(settings_file) if settings_file else {}
    settings = config.settings(raw, checkpoints=checkpoints, once=once or None)
    topics = transport_of(root)
    if job == "bronze":
        queries = [jobs.bronze_job(spark, topics, settings)]
    elif job == "silver":
        queries = jobs.silver_jobs(spark, topics, settings, config.dimensions(spark, raw))
    elif job == "gold":
        queries = [jobs.gold_job(spark, topics, settings)]
    else:
        model = scoring.calibrate(spark.read.parquet(reference)) if reference else scoring.DeviationModel()
        queries = [jobs.scoring_job(spark, topics, settings, [model])]
    try:
        for query in queries:  # an error in one ends the job
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("layer", choices=["produce", "bronze", "silver", "gold", "score", "publish", "stream", "probe"])
    parser.add_argument("source")
    parser.add_argument("out", nargs="?")
    parser.add_argument("--settings", help="YAML or JSON of identity maps, events and job settings")
    parser.add_argument("--checkpoints", help="folder of the streaming jobs' checkpoints")
    parser.add_argument("--once", action="store_true")
    parser.add_argument("--reference", help="Gold samples (Parquet) to calibrate the model on")
    parser.add_argument("--msisdn", help="Parquet of msisdn, imsi")
    parser.add_argument("--mtmsi", help="Parquet of mtmsi, imsi")
    args = parser.parse_args()
    spark = SparkSession.builder.appName(f"uelumen-{args.layer}").getOrCreate()
    if args.layer in ("publish", "stream", "probe"):
        from uelumen.streaming import jobs

        if args.layer == "probe":
            print(jobs.probe(spark, transport_of(args.source)))
        elif args.layer == "publish":
            print(jobs.produce(spark, transport_of(args.out), args.source))
        else:
            stream(spark, args.source, args.out, args.settings, args.checkpoints, args.once, args.reference)
        return
    read = lambda p: spark.read.parquet(p) if p else None
    run(spark, args.layer, args.source, args.out, read(args.msisdn), read(args.mtmsi))


if __name__ == "__main__":
    main()
