"""Throughput between log records of a training run, and one summary per run.

Event records: ``run_id, seq, step, kind, ts, loss, learning_rate``; ``kind`` is one of begin, step,
eval_log (a log without a loss), epoch_end, evaluate, end; ``seq`` breaks ties in ``ts``. ``block``,
``batch`` and ``logging_steps`` may be numbers or columns of the event table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.functions.scalars import rest_of_day, seconds, whole_days
from seqprep.operators.ranges import NARROW_ROWS_PER_RANGE, key_ranges, neighbour
from seqprep.operators.shaping import require_columns

EVENT_SCHEMA = {
    "seq": "bigint",
    "step": "bigint",
    "kind": "string",
    "ts": "timestamp",
    "loss": "double",
}

# Events that restart the clock whatever their step, and the step that is warm-up.
CLOCK_KINDS = ("begin", "eval_log")
WARM_UP_STEP = 1

Number = int | Column


def _col(value: Number) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def is_logged_step(logging_steps: Number) -> Column:
    step = F.col("step")
    sampled = (step % _col(logging_steps) == 0) | (step == WARM_UP_STEP)
    return (F.col("kind") == "step") & sampled


def is_clock_record(logging_steps: Number) -> Column:
    return F.col("kind").isin(*CLOCK_KINDS) | is_logged_step(logging_steps)


def is_interval() -> Column:
    """Clock records that yield an interval: a loss, and not the warm-up step."""
    return (
        F.col("loss").isNotNull() & (F.col("step") != WARM_UP_STEP) & (F.col("kind") == "step")
    )


def logged_steps(events: DataFrame, logging_steps: Number) -> DataFrame:
    """Step records that are logged: every ``logging_steps``-th, and the first."""
    return events.filter(is_logged_step(logging_steps))


def tokens_per_second(block: Number, batch: Number, steps: Column, elapsed: Column) -> Column:
    """Padded tokens of the steps over their seconds; NULL for no elapsed time."""
    tokens = _col(block).cast("double") * _col(batch) * steps
    return F.try_divide(tokens, elapsed)


def clock_intervals(
    events: DataFrame, logging_steps: Number, rows_per_range: int = NARROW_ROWS_PER_RANGE
) -> DataFrame:
    """Clock records with the time and step of the clock record before them in their run.

    Records that restart no clock are filtered out before the exchange.
    """
    require_columns(events, EVENT_SCHEMA)
    clock = events.filter(is_clock_record(logging_steps)).withColumn("_us", F.unix_micros("ts"))
    ranges = key_ranges(clock, ["run_id", "_us", "seq"], rows_per_range)
    return neighbour(clock, ["run_id"], ["_us", "seq"], ["_us", "step"], ranges, name="_before")


def interval_columns(block: Number, batch: Number) -> list[Column]:
    steps = F.col("step") - F.col("_before.step")
    elapsed = seconds(F.col("_us") - F.col("_before._us"))
    return [
        steps.alias("steps"),
        elapsed.alias("seconds"),
        tokens_per_second(block, batch, steps, elapsed).alias("tps"),
        F.try_divide(elapsed, steps.cast("double")).alias("seconds_per_step"),
    ]


def interval_throughput(
    events: DataFrame,
    block: Number,
    batch: Number,
    logging_steps: Number,
    rows_per_range: int = NARROW_ROWS_PER_RANGE,
) -> DataFrame:
    """One row per logged step with a loss: what was done since the clock record before it."""
    timed = clock_intervals(events, logging_steps, rows_per_range).filter(is_interval())
    return timed.select(
        "run_id", "seq", "step", "ts", "loss", "learning_rate", *interval_columns(block, batch)
    )


def run_summary(
    events: DataFrame,
    block: int,
    batch: Number,
    logging_steps: Number,
    rows_per_range: int = NARROW_ROWS_PER_RANGE,
) -> DataFrame:
    """One row per run: mean throughput, mean seconds per step, and durations.

    Mean throughput is the unweighted mean over intervals. A run without an interval is measured
    once, from its last clock record to its last event. The mean step time divides by
    ``intervals * logging_steps - 1``. Warm-up is the last clock interval that ended at step 1.
    Columns given for ``batch`` or ``logging_steps`` must be constant within a run.
    """
    order = F.struct(F.unix_micros("ts"), "seq")
    per_event = events.groupBy("run_id").agg(
        F.min(F.when(F.col("kind") == "begin", F.unix_micros("ts"))).alias("_begin"),
        F.max(F.when(F.col("kind") == "epoch_end", F.unix_micros("ts"))).alias("_epoch_end"),
        F.max(F.when(F.col("kind") == "evaluate", F.unix_micros("ts"))).alias("_evaluate"),
        F.max(F.unix_micros("ts")).alias("_last"),
        F.max("step").alias("_last_step"),
        F.max(_col(batch)).alias("_batch"),
        F.max(_col(logging_steps)).alias("_k"),
    )
    timed = clock_intervals(events, logging_steps, rows_per_range)
    span = F.col("_us") - F.col("_before._us")
    steps, elapsed, tps, _ = interval_columns(block, batch)
    warm_up = (F.col("step") == WARM_UP_STEP) & (F.col("kind") != "begin")
    per_clock = timed.groupBy("run_id").agg(
        F.count(F.when(is_interval(), 1)).alias("_n"),
        F.avg(F.when(is_interval(), tps)).alias("_avg_tps"),
        F.sum(F.when(is_interval(), span)).alias("_sum_us"),
        F.max_by(F.when(warm_up, span), F.when(warm_up, order)).alias("_warm"),
        F.max(F.struct(F.col("_us"), "seq", "step")).alias("_clock"),
    )
    per_clock = per_clock.withColumnRenamed("run_id", "_run")
    joined = per_event.join(per_clock, per_event["run_id"].eqNullSafe(per_clock["_run"]), "left")
    return measured(joined, block)


def measured(runs: DataFrame, block: Number) -> DataFrame:
    """The columns of :func:`run_summary` from what was gathered of each run."""
    tail = F.col("_last") - F.col("_clock._us")
    tail_steps = F.col("_last_step") - F.col("_clock.step")
    tail_tps = tokens_per_second(block, F.col("_batch"), tail_steps, seconds(tail))
    no_interval = F.coalesce(F.col("_n"), F.lit(0)) == 0
    counted = F.greatest(F.coalesce(F.col("_n"), F.lit(0)), F.lit(1))
    total_us = F.when(no_interval, tail).otherwise(F.col("_sum_us"))
    divisor = (counted * F.col("_k") - 1).cast("double")
    found = runs.select(
        "run_id",
        F.coalesce(F.col("_n"), F.lit(0)).alias("intervals"),
        F.when(no_interval, tail_tps).otherwise(F.col("_avg_tps")).alias("avg_tps"),
        F.try_divide(seconds(total_us), divisor).alias("avg_step_seconds"),
        seconds(F.col("_warm")).alias("warm_up_seconds"),
        seconds(F.col("_epoch_end") - F.col("_begin")).alias("train_seconds"),
        F.coalesce(seconds(F.col("_evaluate") - F.col("_epoch_end")), F.lit(0.0)).alias(
            "eval_seconds"
        ),
    )
    total = F.col("train_seconds") + F.col("warm_up_seconds") + F.col("eval_seconds")
    return found.withColumn("total_seconds", total)


def run_eta(summary: DataFrame, steps: Number, epochs: Number) -> DataFrame:
    """Estimated seconds of the whole run, and the same as days and a rest.

    Warm-up enters twice: once as such and once as the first step.
    """
    warm = F.col("warm_up_seconds")
    estimate = (
        warm
        + F.col("avg_step_seconds") * (_col(steps) - 1)
        + warm
        + _col(epochs) * F.col("eval_seconds")
    )
    timed = summary.withColumn("estimated_seconds", estimate)
    return timed.withColumns(
        {
            "estimated_days": whole_days(F.col("estimated_seconds")),
            "estimated_rest_seconds": rest_of_day(F.col("estimated_seconds")),
        }
    )
