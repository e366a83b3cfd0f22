"""The thin queries of the operators: opN_<name>(spark, sf_dir), and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from uelumen.llm import align, bpe, centroids, chat, decontaminate, extract, packing, quality, secrets, simhash, tokenfile, toxicity, warc


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(_read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.write_and_read(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_read(spark, sf_dir, "pages"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    control = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.digests(chat.format_packs(rows.union(control)))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_read(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digest=True, ids=False)


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.align(_read(spark, sf_dir, "documents"), *paths, digest=True)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_read(spark, sf_dir, "embeddings")).drop("centroid")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_warc": op2_warc,
        "op3_decontaminate": op3_decontaminate,
        "op4_tokenfile": op4_tokenfile,
        "op5_extract": op5_extract,
        "op6_chat": op6_chat,
        "op7_secrets": op7_secrets,
        "op8_quality": op8_quality,
        "op9_toxicity": op9_toxicity,
        "op10_bpe": op10_bpe,
        "op11_align": op11_align,
        "op12_centroids": op12_centroids,
        "op13_packing": op13_packing,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": warc.ORACLE_SQL, "op3_decontaminate": decontaminate.ORACLE_SQL, "op6_chat": chat.ORACLE_SQL, "op8_quality": quality.ORACLE_SQL, "op12_centroids": centroids.ORACLE_SQL}
