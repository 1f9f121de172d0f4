"""The corpus pipeline: from raw documents to packed sequences, each stage written and read again as Parquet.

Stages take (spark, docs, sf_dir) and return a frame. All but the last return the columns of documents; rows with null
or empty texts, null ids, equal rows and further columns go through as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from perron.llm import exact, language, mixing, packing, simhash
from perron.session import scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language stays ambiguous, go."""
    return language.accepted(docs, language.train(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact.survivors(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays."""
    return simhash.first_of_groups(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes, in the order of training."""
    return mixing.mix(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document in a sequence, with its token ids."""
    return packing.pack(docs).drop("uid")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mix", source_mix),
    ("sequence_packing", sequence_packing),
]

#: The classifiers of the first stage and the token ids of the last cannot be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    folder = scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
