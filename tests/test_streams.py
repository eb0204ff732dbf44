"""Streams that keep late records, bounded state, and a report merged batch by batch."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from seqprep.operators import telemetry
from seqprep.plans import storage
from seqprep.streaming import incremental, records, throughput
from tests.test_run_state import same
from tests.test_telemetry import BATCH, BLOCK, SCHEMA, START, event, events, runs  # noqa: F401

KEEP = ("run_id", "seq", "step", "steps", "seconds", "tps")


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def sentinel(spark):
    return spark.createDataFrame([(None, 0, 0, "begin", START + dt.timedelta(days=400), None, None)], SCHEMA)


def parts_of(spark, table, n, seed):
    """The table's rows dealt to ``n`` files at random, so that most records come late."""
    rows = table.collect()
    random.Random(seed).shuffle(rows)
    return [spark.createDataFrame(rows[i::n], table.schema) for i in range(n)]


def feed(spark, source, part):
    part.coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(source)


def test_late_records_appear_also_after_a_restart(spark, events):  # noqa: F811
    source, target = storage.scratch_path(spark, "in"), storage.scratch_path(spark, "out")
    for part in [*parts_of(spark, events, 3, 1), sentinel(spark)]:
        arriving = feed(spark, source, part)
        throughput.finish(throughput.stream_throughput(arriving, 5, "1 second", target, 60, True, 20), 1)
    written = spark.read.parquet(f"{target}/clock")
    assert written.filter("late").count() > written.filter("not late").count() / 10
    got = throughput.stream_intervals(spark, target, BLOCK, BATCH).select(*KEEP).collect()
    want = telemetry.interval_throughput(events, BLOCK, BATCH, 5).select(*KEEP).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_a_late_record_mends_its_neighbour(spark):
    at = lambda *rows: spark.createDataFrame(list(rows), SCHEMA)
    parts = [
        at(event(1, 0, "begin", 0), event(1, 1, "step", 10, 5, 1.0), event(1, 3, "step", 30, 15, float("nan"))),
        at(event(2, 0, "begin", 1000)),
        at(event(1, 2, "step", 20, 10, 1.0), event(3, 0, "step", 5, 5, 1.0)),
        sentinel(spark),
    ]
    source, target = storage.scratch_path(spark, "in"), storage.scratch_path(spark, "out")
    seen = []
    for part in parts:
        arriving = feed(spark, source, part)
        throughput.finish(throughput.stream_throughput(arriving, 5, "100 seconds", target, 60, True), 1)
        found = throughput.stream_intervals(spark, target, BLOCK, BATCH).filter("run_id = 1").collect()
        seen.append(sorted((r["step"], r["steps"], r["seconds"]) for r in found))
    assert seen == [[], [(5, 5, 10.0), (15, 10, 20.0)]] + [[(5, 5, 10.0), (10, 5, 10.0), (15, 5, 10.0)]] * 2


def test_no_state_entry_outgrows_a_record(spark, monkeypatch):
    """A thousand records of one tick of one run: what the state holds under one key."""
    rows = [event(1, i, "step", 7, 5, 1.0) for i in range(1000)]
    table = spark.createDataFrame([event(1, -1, "begin", 0), *rows], SCHEMA)
    source, target = storage.scratch_path(spark, "in"), storage.scratch_path(spark, "out")
    arriving = feed(spark, source, table)
    throughput.finish(throughput.stream_throughput(arriving, 5, "1 day", target, 60, True, 60), 1)
    held = (
        spark.read.format("statestore").option("stateVarName", "held").option("flattenCollectionTypes", True)
        .load(f"{target}/progress").select(F.length(F.to_json("user_map_value")).alias("n"))
    )
    assert held.count() == 1001 and held.agg(F.max("n")).first()[0] < 250


def test_state_keys_do_not_follow_the_number_of_runs(spark):
    """A key costs milliseconds by itself: runs share one, and keep their own records and exact numbers."""
    far = 2**60 + 1
    rows = [r for i in range(600) for r in (event(far + i, far, "begin", 0), event(far + i, far + 2, "step", 10, 5, 1.0))]
    table = spark.createDataFrame([*rows, event(None, None, "step", 7, 5, 1.0)], SCHEMA)
    source, target = storage.scratch_path(spark, "in"), storage.scratch_path(spark, "out")
    arriving = feed(spark, source, table)
    throughput.finish(throughput.stream_throughput(arriving, 5, "1 day", target, 3600, True, 3600), 1)
    held = spark.read.format("statestore").option("stateVarName", "counts").load(f"{target}/progress")
    assert held.count() <= 256
    throughput.finish(throughput.stream_throughput(feed(spark, source, sentinel(spark)), 5, "1 day", target, 3600, True, 3600), 1)
    got = throughput.stream_intervals(spark, target, BLOCK, BATCH).filter("run_id is not null").collect()
    assert sorted((r["run_id"], r["seq"], r["seconds"]) for r in got) == [(far + i, far + 2, 10.0) for i in range(600)]


def test_a_held_record_is_one_text_and_comes_back_exactly(spark):
    """Each field of an entry costs conversions in every call to the store, 2 million of them at 60 x sf0.1."""
    far = 2**60 + 1
    rows = [
        event(far, far, "begin", 0),
        event(far, far + 1, "step", 10, 5, float("nan")),
        event(far, far + 2, "step", 20, 10, 0.1 + 0.2),
        event(far, far + 3, "step", 30, 15, float("-inf")),
        event(far, far + 4, "eval_log", 40, 15),
    ]
    named = spark.createDataFrame(rows, SCHEMA).withColumn("run_id", F.concat(F.lit('é"\\'), F.col("run_id").cast("string")))
    end = sentinel(spark).withColumn("run_id", F.col("run_id").cast("string"))
    source, target = storage.scratch_path(spark, "in"), storage.scratch_path(spark, "out")
    throughput.finish(throughput.stream_throughput(feed(spark, source, named), 5, "1 day", target, 60, True, 20), 1)
    held = spark.read.format("statestore").option("stateVarName", "held").load(f"{target}/progress")
    assert held.schema["user_map_value"].dataType.names == ["record"]
    throughput.finish(throughput.stream_throughput(feed(spark, source, end), 5, "1 day", target, 60, True, 20), 1)
    found = spark.read.parquet(f"{target}/clock").filter("run_id is not null").orderBy("us").collect()
    assert [(r["run_id"], r["seq"], str(r["loss"]), r["learning_rate"]) for r in found] == [
        (f'é"\\{far}', r[1], str(r[5]), r[6]) for r in rows
    ]


def test_an_aggregate_behind_the_state(spark, events, tmp_path):  # noqa: F811
    source = storage.scratch_path(spark, "in")
    feed(spark, source, events)
    arriving = feed(spark, source, sentinel(spark))
    with records.rocks_store(spark):
        started = (
            records.span_report_stream(arriving, 5, "1 day", 60, 20).writeStream.format("parquet")
            .option("path", f"{tmp_path}/report").option("checkpointLocation", f"{tmp_path}/progress")
            .trigger(availableNow=True).start()
        )
    throughput.finish(started, 1)
    got = {(r["run_id"], r["span_start"]): (r["intervals"], r["sum_us"]) for r in spark.read.parquet(f"{tmp_path}/report").collect()}
    clock = telemetry.clock_intervals(events, 5).withColumn("span", F.window("ts", "60 seconds")["start"])
    inside = clock.withColumn("before", F.timestamp_micros("_before._us")).filter("before >= span").filter(telemetry.is_interval())
    want = inside.groupBy("run_id", "span").agg(F.count("*").alias("n"), F.sum(F.col("_us") - F.col("_before._us")).alias("us"))
    assert {k: v for k, v in got.items() if v[0]} == {(r["run_id"], r["span"]): (r["n"], r["us"]) for r in want.collect()}


def drop_last_commit(target):
    """What a crash leaves after a batch has written its tables and before it is committed."""
    commits = f"{target}/progress/commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    os.remove(f"{commits}/{last}")
    for name in os.listdir(commits):
        if name.startswith(f".{last}."):
            os.remove(f"{commits}/{name}")
    return last


@pytest.mark.parametrize("delay, n, again", [("1 second", 4, (1,)), ("30 days", 2, (2,))])
def test_totals_of_batches_equal_the_batch_report(spark, events, delay, n, again):  # noqa: F811
    """Batches in no order of time, one of them run again; then the stream's end."""
    source, target = storage.scratch_path(spark, "in"), storage.scratch_path(spark, "totals")
    totals, replayed = incremental.RunTotals(spark, target), []
    for i, part in enumerate([*parts_of(spark, events, n, 3), sentinel(spark)]):
        arriving = feed(spark, source, part)
        start = lambda: incremental.stream_summary_incremental(arriving, 5, BATCH, delay, target, 60, 20)  # noqa: E731, B023
        throughput.finish(start(), 1)
        if i in again:
            replayed.append(drop_last_commit(target))
            before = sorted(map(str, totals.summary(BLOCK).collect()))
            throughput.finish(start(), 1)
            if replayed[-1] == totals.last_batch():
                assert sorted(map(str, totals.summary(BLOCK).collect())) == before
    assert len(replayed) == 1
    want = telemetry.run_summary(events, BLOCK, BATCH, 5)
    same(totals.summary(BLOCK).filter("run_id is not null"), want)
    kept = [n for n in storage.list_names(spark, f"{target}/totals") if n.startswith("of_batch=")]
    assert len(kept) <= incremental.KEPT_TOTALS


def test_late_records_are_exchanged_once(spark, events):  # noqa: F811
    """Spans with late records are put in order by one exchange of their records, without a join."""
    source, target = storage.scratch_path(spark, "in"), storage.scratch_path(spark, "totals")
    for part in parts_of(spark, events, 2, 5):
        arriving = feed(spark, source, part)
        throughput.finish(incremental.stream_summary_incremental(arriving, 5, BATCH, "1 second", target, 60, 20), 1)
    totals = incremental.RunTotals(spark, target)
    last = totals.last_batch()
    found = spark.read.parquet(f"{target}/records").filter("late").agg(F.max("of_batch"), F.min("span"), F.max("span")).first()
    assert found[0] is not None and found[0] <= last
    schema = spark.read.parquet(f"{target}/records/of_batch={found[0]}").schema
    mended = totals._mended(schema, found[1], found[2], found[0])
    plan = mended._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    states = spark.read.parquet(f"{target}/states/of_batch={found[0]}").filter("mended")
    assert not mended.isEmpty() and sorted(map(str, mended.collect())) == sorted(map(str, states.drop("mended").collect()))


def test_totals_without_their_predecessor_are_refused(spark):
    rows = spark.createDataFrame([event(1, 0, "begin", 0)], SCHEMA)
    empty = incremental.RunTotals(spark, storage.scratch_path(spark, "totals"))
    with pytest.raises(RuntimeError, match="no finished batch"):
        empty.summary(BLOCK)
    with pytest.raises(RuntimeError, match="left no totals"):
        empty._totals(4)
    assert rows.count() == 1
