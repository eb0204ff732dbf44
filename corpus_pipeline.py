"""Documents to a sharded training mix: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqprep.llm.decontaminate import decontaminate
from seqprep.llm.languages import drop_unidentified
from seqprep.llm.mixture import mixed
from seqprep.llm.near_dups import drop_near_duplicates
from seqprep.llm.shards import shards
from seqprep.plans.inputs import table
from seqprep.plans.storage import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_unidentified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shards(docs, carry=True)


STAGES = [
    ("language_id", language_id),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing),
    ("sharding", sharding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
