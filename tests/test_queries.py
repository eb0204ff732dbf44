"""Every query against its SQL equivalent, and the shape of the plans."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import check
from seqprep.plans.catalog import QUERIES
from seqprep.plans.oracle import ORACLE_SQL

NAMES = list(QUERIES)


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(NAMES) and set(NAMES) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql_without_a_cross_join(spark, sf_dir, name):
    built = {}
    assert check.compare(spark, sf_dir, [name], built) == []
    if not name.startswith("stream_"):
        plan = built[name]._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan
        assert "NestedLoopJoin" not in plan


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[:3] == ["conv_id", "turn", "split"]
    assert frame.count() > 0
