"""The pipeline and the registered queries against SQL and against its stages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import check
import corpus_pipeline
from seqprep.llm.oracle import ORACLE_SQL
from seqprep.plans.inputs import table


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert check.compare(spark, sf_dir, [name]) == []


def test_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names


def test_stages_act_in_order(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    names, rows = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, rows = rows, corpus_pipeline.written(stage(spark, rows, sf_dir), name)
        assert rows.columns == names
        assert rows.join(before, names, "left_anti").isEmpty()
    assert rows.count() > rows.distinct().count()
    last = corpus_pipeline.run(spark, sf_dir)
    assert last.select(*names).exceptAll(rows).isEmpty() and last.count() == rows.count()
    slots = last.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m"))
    assert slots.filter("n <> m + 1").isEmpty()
