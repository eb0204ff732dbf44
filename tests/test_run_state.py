"""States of stretches of a run: however a run is cut, merged states report as its events do."""

from __future__ import annotations

import datetime as dt
import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from seqprep.operators import run_state, telemetry
from tests.test_telemetry import BATCH, BLOCK, SCHEMA, START, event, events, runs  # noqa: F401

NAMES = ("avg_tps", "avg_step_seconds", "warm_up_seconds", "train_seconds", "eval_seconds", "total_seconds")


def same(got, want):
    got, want = ({r["run_id"]: r for r in rows.collect()} for rows in (got, want))
    assert set(got) == set(want)
    for run, row in want.items():
        assert got[run]["intervals"] == row["intervals"], run
        for name in NAMES:
            assert got[run][name] == (None if row[name] is None else pytest.approx(row[name])), (run, name)


def cut_at(borders):
    """Number of borders at or before an event; events of equal time may be cut by ``seq``."""
    at = F.struct(F.unix_micros("ts"), "seq")
    parts = [F.when(at >= F.struct(F.lit(us).cast("bigint"), F.lit(seq).cast("bigint")), 1).otherwise(0) for us, seq in borders]
    return reduce(lambda a, b: a + b, parts, F.lit(0))


@pytest.mark.parametrize("k", [1, 5, 1000])
@pytest.mark.parametrize("cuts", [0, 1, 7, 60])
def test_any_cut_gives_the_batch_answer(runs, events, k, cuts):  # noqa: F811
    pick = random.Random(cuts)
    every = [e for run in runs.values() for e in run]
    borders = sorted(
        (int((e[4] - START) / dt.timedelta(microseconds=1)) + int(START.timestamp()) * 10**6, e[1])
        for e in pick.sample(every, cuts)
    )
    states = run_state.stretch_states(events, k, BATCH, cut_at(borders), 100 if cuts == 7 else 10**6)
    want = telemetry.run_summary(events, BLOCK, BATCH, k)
    same(run_state.state_summary(run_state.merge_states([states]), BLOCK), want)
    # Neighbours first, then groups of neighbours.
    groups = states.withColumn("group", F.floor(F.col("stretch") / 3))
    nested = run_state.merge_states([run_state.merge_states([groups.drop("stretch")], ["group"]).drop("group")])
    same(run_state.state_summary(nested, BLOCK), want)


def test_one_more_day_reads_no_older_events(spark, events):  # noqa: F811
    border = F.timestamp_micros(F.lit((int(START.timestamp()) + 90) * 10**6))
    old = run_state.stretch_states(events.filter(F.col("ts") < border), 5, BATCH).drop("stretch")
    kept = spark.createDataFrame(old.collect(), old.schema)
    new = run_state.stretch_states(events.filter(F.col("ts") >= border), 5, BATCH).drop("stretch")
    whole = run_state.merge_states([kept, new])
    same(run_state.state_summary(whole, BLOCK), telemetry.run_summary(events, BLOCK, BATCH, 5))


def test_awkward_runs(spark):
    rows = [
        (None, 1, 0, "begin", START, None, None), (None, 2, 5, "step", START + dt.timedelta(seconds=9), 1.0, None),
        event(1, 1, "end", 5, 3), event(2, 1, "step", 1, 1, 1.0), event(2, 2, "step", 1, 5, 2.0), event(2, 2, "step", 1, 5, 2.0),
        (3, 1, None, None, START, None, None), event(4, 1, "begin", 0), event(4, 2, "step", 0, 5, 1.0),
    ]
    table = spark.createDataFrame(rows, SCHEMA)
    states = run_state.stretch_states(table, 5, BATCH, F.col("seq"))
    want = telemetry.run_summary(table, BLOCK, BATCH, 5)
    same(run_state.state_summary(run_state.merge_states([states]), BLOCK), want)
    none = run_state.stretch_states(table.limit(0), 5, BATCH)
    assert run_state.state_summary(run_state.merge_states([none]), BLOCK).count() == 0
