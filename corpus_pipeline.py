"""Corpus pipeline: quality rules, near-duplicates, benchmark passages, secrets, tokens.

Each stage takes what its predecessor kept, written as Parquet and read again; all but the last return the columns of
``documents``, whatever they are called.

Defined results of every stage: a null text is an empty one and fails the quality rules; repeated rows are one group, of which the near-duplicate stage keeps
the first; of a group the smallest doc_id stays, a null one only if there is no other; texts are read whole whatever their length; an empty table gives an empty
result. The modules of the operators say the rest.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from uelumen.llm import bpe, decontaminate, quality, secrets, simhash
from uelumen.llm.common import scope, stage_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that repeat across documents of their host."""
    with scope("pipeline", spark):  # the tables of the stage before are no longer read
        return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    with scope("pipeline", spark):  # the tables of the stage before are no longer read
        return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    with scope("pipeline", spark):  # the tables of the stage before are no longer read
        return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    with scope("pipeline", spark):  # the tables of the stage before are no longer read
        return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the hashes of ids and decoded text."""
    with scope("pipeline", spark):  # the tables of the stage before are no longer read
        return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), digest=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("tokens", tokens),
]

#: The stages for near-duplicates, secrets and tokens can't be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
