"""Registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.llm import (
    alignment,
    decontaminate,
    edits,
    filter_audit,
    host_rules,
    languages,
    licenses,
    mixture,
    near_dups,
    neural_lm,
    shards,
    suffixes,
    url_filters,
)
from seqprep.plans.inputs import table


def op1_conditional_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_notices(table(spark, sf_dir, "documents"))


def op2_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_spans(table(spark, sf_dir, "documents"))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents"))


def op4_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shards(table(spark, sf_dir, "documents"))


def op5_minhash_oph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def document_edits() -> Column:
    """Three edits of every document: a replacement, a deletion and an addition at its end."""
    size = F.char_length(F.coalesce("text", F.lit("")))
    draw = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    change = lambda start, stop, insert: F.struct(
        start.cast("int").alias("start"), stop.cast("int").alias("stop"), insert.alias("insert")
    )
    first, second = draw % (size + 1), F.floor(draw / 7).cast("bigint") % (size + 1)
    return F.array(
        change(first, first + 12, F.concat(F.lit(" "), F.col("source"), F.lit(" "))),
        change(second, second + 40, F.lit("")),
        change(F.lit(2**31 - 1), F.lit(2**31 - 1), F.concat(F.lit("\n"), F.col("lang"))),
    )


def op6_edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits.count_edited(table(spark, sf_dir, "documents"), document_edits())


def op7_fair_queueing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixture.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op8_hyperdimensional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify(table(spark, sf_dir, "documents"))


def op9_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neural_lm.score(table(spark, sf_dir, "documents"))


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


def op12_shared_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digests(table(spark, sf_dir, "documents"))


def op13_decision_diagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_conditional_compression,
        op2_sparse_suffixes,
        op3_host_rules,
        op4_external_shuffle,
        op5_minhash_oph,
        op6_edited_token_counts,
        op7_fair_queueing,
        op8_hyperdimensional,
        op9_log_bilinear,
        op10_winnowing,
        op11_link_graph,
        op12_shared_cuts,
        op13_decision_diagrams,
    )
}
