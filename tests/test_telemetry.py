"""Run reports against a plain fold over the events of each run, and stream against batch."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seqprep.sources import run_logs
from seqprep.operators import telemetry
from seqprep.plans import inputs, storage
from seqprep.streaming import throughput

SCHEMA = "run_id bigint, seq bigint, step bigint, kind string, ts timestamp, loss double, learning_rate double"
START = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
BLOCK, BATCH = 1024, 64


def event(run, seq, kind, second, step=0, loss=None):
    return (run, seq, step, kind, START + dt.timedelta(seconds=second), loss, 1e-5)


def run_of(run, rng, steps):
    """Events of one run: begin, steps, now and then a log without a loss, ends of epochs."""
    at, seq, out = float(rng.randint(0, 50)), 0, []

    def add(kind, step, loss=None):
        nonlocal seq, at
        out.append(event(run, seq, kind, at, step, loss))
        seq += 1
        at += rng.choice([0.0, 0.25, 1.5, 7.0])

    add("begin", 0)
    for step in range(1, steps + 1):
        add("step", step, rng.choice([1.5, 2.25, float("nan")]))
        if rng.random() < 0.15:
            add("eval_log", step)
        if step % 40 == 0 or step == steps:
            add("epoch_end", step)
            if run % 5:
                add("evaluate", step)
    return out


@pytest.fixture(scope="module")
def runs():
    """Run 1 has far more events than all the others together; run 9 has no step at all."""
    rng = random.Random(5)
    sizes = {1: 400, 2: 3, 3: 17, 4: 60, 5: 90, 6: 1, 7: 41, 9: 0}
    return {run: run_of(run, rng, size) for run, size in sizes.items()}


@pytest.fixture(scope="module")
def events(spark, runs):
    rows = [e for run in runs.values() for e in run]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def fold(run, k):
    """The reports of a run, event by event."""
    clock = warm = None
    out, begin, epoch_end, evaluate = [], None, None, None
    for _, seq, step, kind, ts, loss, _lr in sorted(run, key=lambda e: (e[4], e[1])):
        at = (ts - START) / dt.timedelta(microseconds=1)
        begin = at if kind == "begin" and begin is None else begin
        epoch_end = at if kind == "epoch_end" else epoch_end
        evaluate = at if kind == "evaluate" else evaluate
        if kind in ("begin", "eval_log") or kind == "step" and (step % k == 0 or step == 1):
            if step == 1:
                warm = at - clock[0]
            elif loss is not None:
                out.append((seq, step - clock[1], (at - clock[0]) / 1e6))
            clock, last = (at, step), at
        last, last_step = at, step
    if not out:
        measured = [(None, last_step - clock[1], (last - clock[0]) / 1e6)]
    else:
        measured = out
    rates = [BLOCK * BATCH * n / s for _, n, s in measured if s]
    divisor = len(measured) * k - 1
    return {
        "intervals": out,
        "avg_tps": sum(rates) / len(rates) if rates else None,
        "avg_step_seconds": sum(s for _, _, s in measured) / divisor if divisor else None,
        "warm_up_seconds": None if warm is None else warm / 1e6,
        "train_seconds": None if epoch_end is None else (epoch_end - begin) / 1e6,
        "eval_seconds": 0.0 if evaluate is None else (evaluate - epoch_end) / 1e6,
    }


@pytest.mark.parametrize("per_range", [100_000, 40])
@pytest.mark.parametrize("k", [1, 5, 1000])
def test_reports_equal_the_fold(runs, events, k, per_range):
    intervals = telemetry.interval_throughput(events, BLOCK, BATCH, k, per_range)
    got = {}
    for row in intervals.collect():
        got.setdefault(row["run_id"], []).append((row["seq"], row["steps"], row["seconds"]))
    summary = {
        r["run_id"]: r
        for r in telemetry.run_summary(events, BLOCK, F.lit(BATCH), k, per_range).collect()
    }
    assert set(summary) == set(runs)
    for run, rows in runs.items():
        want = fold(rows, k)
        assert sorted(got.get(run, [])) == sorted(want["intervals"])
        found = summary[run]
        assert found["intervals"] == len(want["intervals"])
        for name in ("avg_tps", "avg_step_seconds", "warm_up_seconds", "train_seconds", "eval_seconds"):
            assert found[name] == (None if want[name] is None else pytest.approx(want[name])), (run, name)


def small(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_logged_steps(spark):
    rows = [event(1, s, "step", s, s, 1.0) for s in range(1, 11)]
    got = telemetry.logged_steps(small(spark, *rows), 5)
    assert sorted(r["step"] for r in got.collect()) == [1, 5, 10]


def test_interval_rate(spark):
    rows = [event(1, 0, "begin", 0), event(1, 1, "step", 3, 1, 1.0), event(1, 2, "eval_log", 5, 20),
            event(1, 3, "step", 15, 40, 1.0)]
    got = telemetry.interval_throughput(small(spark, *rows), 1024, 64, 20).collect()
    assert [(r["step"], r["steps"], r["seconds"], r["tps"], r["seconds_per_step"]) for r in got] == [
        (40, 20, 10.0, 131072.0, 0.5)
    ]


def test_mean_step_seconds(spark):
    rows = [event(1, 0, "begin", 0), event(1, 1, "step", 1, 1, 1.0), event(1, 2, "step", 5, 5, 1.0),
            event(1, 3, "step", 10, 10, 1.0)]
    assert telemetry.run_summary(small(spark, *rows), 1, 1, 5).collect()[0]["avg_step_seconds"] == 1.0
    one = [event(1, 0, "begin", 0), event(1, 1, "step", 4, 2, 1.0)]
    assert telemetry.run_summary(small(spark, *one), 1, 1, 1).collect()[0]["avg_step_seconds"] is None


def test_estimate_counts_warm_up_twice(spark):
    summary = spark.createDataFrame([(1, 30.0, 0.5, 10.0)],
        "run_id int, warm_up_seconds double, avg_step_seconds double, eval_seconds double")
    row = telemetry.run_eta(summary, 100, 1).collect()[0]
    assert (row["estimated_seconds"], row["estimated_days"]) == (119.5, 0)
    long = telemetry.run_eta(summary, 1_000_000, 1).collect()[0]
    assert (long["estimated_days"], long["estimated_rest_seconds"]) == (5, 500_069.5 - 5 * 86_400)


def test_events_of_the_wrong_shape_are_refused(spark):
    with pytest.raises(TypeError, match="kind"):
        telemetry.interval_throughput(spark.range(1), 1, 1, 1)


def test_run_events_do_not_depend_on_the_number_of_ranges(spark, sf_dir):
    one = inputs.run_events(spark, sf_dir)
    many = inputs.run_events(spark, sf_dir, rows_per_range=60)
    assert one.exceptAll(many).isEmpty() and one.count() == many.count()


def stream_of(spark, parts, delay, by_record, k=5, span=60):
    """Feed files one by one, each in its own batch, then a far-future event."""
    source, target = storage.scratch_path(spark, "in"), storage.scratch_path(spark, "out")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
        arriving = (
            spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(source)
        )
        started = throughput.stream_throughput(arriving, k, delay, target, span, by_record)
        throughput.finish(started, 1)
    return target


def sentinel(spark):
    return small(spark, (None, 0, 0, "begin", START + dt.timedelta(days=400), None, None))


@pytest.mark.parametrize("by_record", [False, True])
def test_stream_equals_batch_in_any_order(spark, events, by_record):
    quarter = F.ntile(4).over(Window.orderBy("ts", "run_id", "seq"))
    numbered = events.withColumn("_q", quarter).cache()
    parts = [numbered.filter(F.col("_q") == q).drop("_q") for q in (3, 1, 4, 2)]
    target = stream_of(spark, [*parts, sentinel(spark)], "30 days", by_record)
    got = throughput.stream_intervals(spark, target, BLOCK, BATCH)
    want = telemetry.interval_throughput(events, BLOCK, BATCH, 5)
    keep = ("run_id", "seq", "step", "steps", "seconds", "tps")
    assert sorted(map(tuple, got.select(*keep).collect())) == sorted(map(tuple, want.select(*keep).collect()))
    running = {r["run_id"]: r for r in throughput.stream_summary(got, 5).collect()}
    summary = telemetry.run_summary(events, BLOCK, BATCH, 5).filter("intervals > 0").collect()
    assert set(running) == {r["run_id"] for r in summary}
    for row in summary:
        assert running[row["run_id"]]["avg_tps"] == pytest.approx(row["avg_tps"])
        assert running[row["run_id"]]["avg_step_seconds"] == pytest.approx(row["avg_step_seconds"])


def test_a_record_need_not_wait_for_its_span(spark):
    first = small(spark, event(1, 0, "begin", 0), event(1, 1, "step", 10, 5, 1.0))
    later = small(spark, event(2, 0, "begin", 130))
    target = stream_of(spark, [first, later], "100 seconds", by_record=True)
    assert throughput.stream_intervals(spark, target, BLOCK, BATCH).count() == 1


@pytest.mark.parametrize("by_record", [False, True])
def test_records_behind_the_watermark_come_out_before_the_end(spark, by_record):
    first = small(spark, event(1, 0, "begin", 0), event(1, 1, "step", 10, 5, 1.0))
    later = small(spark, event(2, 0, "begin", 1000))
    target = stream_of(spark, [first, later], "100 seconds", by_record)
    got = throughput.stream_intervals(spark, target, BLOCK, BATCH)
    assert [(r["run_id"], r["step"], r["seconds"]) for r in got.collect()] == [(1, 5, 10.0)]


def test_late_records_of_whole_spans_are_reported(spark):
    now = small(spark, event(1, 0, "begin", 1000))
    late = small(spark, event(1, 1, "step", 10, 5, 1.0))
    with pytest.raises(RuntimeError, match="after the watermark"):
        stream_of(spark, [now, late], "10 seconds", by_record=False)


def test_an_event_of_any_kind_moves_the_watermark(spark, tmp_path):
    schema = "run_id bigint, seq bigint, step bigint, kind string, ts timestamp, loss double, learning_rate double"
    rows = [(1, 1, 0, "begin", 0), (1, 2, 5, "step", 10), (1, 3, 10, "step", 20), (2, 4, 3, "evaluate", 50_000)]
    at = lambda s: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)
    table = spark.createDataFrame([(r, q, n, k, at(s), 1.0, 0.1) for r, q, n, k, s in rows], schema)
    table.coalesce(1).write.parquet(f"{tmp_path}/in")
    events = spark.readStream.schema(table.schema).parquet(f"{tmp_path}/in")
    throughput.finish(throughput.stream_throughput(events, 5, "10 seconds", f"{tmp_path}/out"))
    assert spark.read.parquet(f"{tmp_path}/out/clock").count() == 3


def test_reading_tasks_do_not_follow_the_number_of_logs(spark, tmp_path):
    for i in range(100):
        folder = tmp_path / f"log={i}_240101_000000.log"
        folder.mkdir()
        (folder / "part-00000.txt").write_text("Start: a run\n")
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(2**30))
    try:
        found = run_logs.read_run_logs(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() <= 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert sorted(int(r["run"]) for r in found.collect()) == list(range(100))
    finally:
        spark.conf.set(name, before)
