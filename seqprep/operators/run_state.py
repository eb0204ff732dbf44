"""What is known of a run after a stretch of it, in one row that can be added to.

A state is a summary of consecutive events of a run: what its clock intervals add up to, and its first
and last clock record, the only ones whose intervals reach beyond the stretch. Two states of
neighbouring stretches merge by the one interval between them; how a run is cut into stretches, and
in which groups of neighbours they are merged, changes nothing. Yesterday's state and today's events
give today's report without reading yesterday's events.

Columns: ``run_id`` and the labels of the stretch; ``first`` and ``last`` clock record, NULL without
one; ``intervals``, ``sum_us``, and ``rates`` of ``rated`` intervals (steps per second; those of no
time have none); ``warm``, the latest warm-up; and the smallest or largest of facts that need no order.
Stretches of a run must not overlap in the order of (time, seq); a group of stretches is one row each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqprep.functions.scalars import seconds
from seqprep.operators.ranges import NARROW_ROWS_PER_RANGE, key_ranges, neighbour
from seqprep.operators.shaping import require_columns
from seqprep.operators.telemetry import (
    EVENT_SCHEMA,
    WARM_UP_STEP,
    Number,
    _col,
    is_clock_record,
    is_interval,
    measured,
)

STRETCH = "stretch"
# Facts of a run that do not depend on order: how they combine.
LEAST = ("begin_us",)
MOST = ("epoch_end_us", "evaluate_us", "last_us", "last_step", "batch", "logging_steps")
FACTS = (*LEAST, *MOST)


def is_warm_up() -> Column:
    """Clock records that end a warm-up."""
    return (F.col("step") == WARM_UP_STEP) & (F.col("kind") != "begin")


def interval_sums(us: Column, steps: Column, yields: Column, warms: Column) -> list[Column]:
    """Aggregates over clock records: ``us`` and ``steps`` are NULL for one without a predecessor."""
    counted = yields & us.isNotNull()
    rate = F.try_divide(steps.cast("double"), seconds(us))
    return [
        F.count(F.when(counted, 1)).alias("intervals"),
        F.coalesce(F.sum(F.when(counted, us)), F.lit(0)).alias("sum_us"),
        F.coalesce(F.sum(F.when(counted, rate)), F.lit(0.0)).alias("rates"),
        F.count(F.when(counted, rate)).alias("rated"),
        F.max(
            F.when(warms & us.isNotNull(), F.struct(F.col("us"), F.col("seq"), us.alias("span")))
        ).alias("warm"),
    ]


def ends_of_stretch(present: Column) -> list[Column]:
    """Aggregates over clock records: the first one with what its interval will need, and the last."""
    first = F.struct("us", "seq", "step", "yields", "warms")
    return [
        F.min(F.when(present, first)).alias("first"),
        F.max(F.when(present, F.struct("us", "seq", "step"))).alias("last"),
    ]


def facts(kind: Column, us: Column, step: Column, batch: Number, logging_steps: Number) -> list[Column]:
    """Aggregates over all events, in any order."""
    return [
        F.min(F.when(kind == "begin", us)).alias("begin_us"),
        F.max(F.when(kind == "epoch_end", us)).alias("epoch_end_us"),
        F.max(F.when(kind == "evaluate", us)).alias("evaluate_us"),
        F.max(us).alias("last_us"),
        F.max(step).alias("last_step"),
        F.max(_col(batch)).cast("bigint").alias("batch"),
        F.max(_col(logging_steps)).cast("bigint").alias("logging_steps"),
    ]


def stretch_states(
    events: DataFrame,
    logging_steps: Number,
    batch: Number,
    stretch: Column | None = None,
    rows_per_range: int = NARROW_ROWS_PER_RANGE,
) -> DataFrame:
    """One state per run and ``stretch``, a label that never falls as time goes on (one for all if None).

    Clock records alone are put in order; other events are combined where they lie.
    """
    require_columns(events, EVENT_SCHEMA)
    label = F.lit(0) if stretch is None else stretch
    rows = events.withColumns(
        {
            STRETCH: label,
            "us": F.unix_micros("ts"),
            "_batch": _col(batch),
            "_every": _col(logging_steps),
            "_is_clock": is_clock_record(logging_steps),
        }
    )
    clock = rows.filter("_is_clock").select(
        "run_id", STRETCH, "us", "seq", "step", is_interval().alias("yields"), is_warm_up().alias("warms")
    )
    order = ["us", "seq"]
    ranges = key_ranges(clock, ["run_id", STRETCH, *order], rows_per_range)
    clock = neighbour(clock, ["run_id", STRETCH], order, ["us", "step"], ranges, name="_before")
    by_clock = clock.groupBy("run_id", STRETCH).agg(
        *ends_of_stretch(F.lit(True)),
        *interval_sums(
            F.col("us") - F.col("_before.us"),
            F.col("step") - F.col("_before.step"),
            F.col("yields"),
            F.col("warms"),
        ),
    )
    known = rows.groupBy("run_id", STRETCH).agg(
        *facts(F.col("kind"), F.col("us"), F.col("step"), F.col("_batch"), F.col("_every"))
    )
    return merge_states([known_states(known, [STRETCH]), clock_states(by_clock, [STRETCH])], [STRETCH])


def clock_states(rows: DataFrame, labels: Sequence[str] = ()) -> DataFrame:
    """States that know clock records only."""
    none = [F.lit(None).cast("bigint").alias(name) for name in FACTS]
    return rows.select(
        "run_id", *labels, "first", "last", "intervals", "sum_us", "rates", "rated", "warm", *none
    )


def known_states(rows: DataFrame, labels: Sequence[str] = ()) -> DataFrame:
    """States that know facts only."""
    first = "struct<us:bigint, seq:bigint, step:bigint, yields:boolean, warms:boolean>"
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    return rows.select(
        "run_id",
        *labels,
        none(first, "first"),
        none("struct<us:bigint, seq:bigint, step:bigint>", "last"),
        *[F.lit(0).cast("bigint").alias(name) for name in ("intervals", "sum_us")],
        F.lit(0.0).alias("rates"),
        F.lit(0).cast("bigint").alias("rated"),
        none("struct<us:bigint, seq:bigint, span:bigint>", "warm"),
        *FACTS,
    )


def merge_states(states: Sequence[DataFrame], labels: Sequence[str] = ()) -> DataFrame:
    """One state per run, and per ``labels``, from the states of its stretches, in their own order.

    The result is a state again: days merge to months, and months to a run.
    """
    every = states[0]
    for more in states[1:]:
        every = every.unionByName(more)
    group = ["run_id", *labels]
    # States without a clock record sort last and lend nothing.
    order = Window.partitionBy(*group).orderBy(F.col("first").asc_nulls_last())
    every = every.withColumn("_from", F.lag("last").over(order))
    gap = F.col("first.us") - F.col("_from.us")
    steps = F.col("first.step") - F.col("_from.step")
    counted = F.col("first.yields") & gap.isNotNull()
    rate = F.try_divide(steps.cast("double"), seconds(gap))
    zero = lambda value, other: F.coalesce(F.when(counted, value), F.lit(other))
    warm = F.when(
        F.col("first.warms") & gap.isNotNull(),
        F.struct(F.col("first.us").alias("us"), F.col("first.seq").alias("seq"), gap.alias("span")),
    )
    return every.groupBy(*group).agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.sum(F.col("intervals") + counted_number(counted)).alias("intervals"),
        F.sum(F.col("sum_us") + zero(gap, 0)).alias("sum_us"),
        F.sum(F.col("rates") + zero(rate, 0.0)).alias("rates"),
        F.sum(F.col("rated") + counted_number(counted & rate.isNotNull())).alias("rated"),
        F.max(F.greatest("warm", warm)).alias("warm"),
        *[F.min(name).alias(name) for name in LEAST],
        *[F.max(name).alias(name) for name in MOST],
    )


def counted_number(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("bigint")


def state_summary(states: DataFrame, block: Number) -> DataFrame:
    """The run report of states that cover whole runs, as ``run_summary`` gives it of their events."""
    tokens = _col(block).cast("double") * F.col("batch")
    runs = states.select(
        "run_id",
        F.col("intervals").alias("_n"),
        (tokens * F.try_divide(F.col("rates"), F.col("rated").cast("double"))).alias("_avg_tps"),
        F.when(F.col("intervals") > 0, F.col("sum_us")).alias("_sum_us"),
        F.col("warm.span").alias("_warm"),
        F.struct(F.col("last.us").alias("_us"), F.col("last.seq").alias("seq"), F.col("last.step").alias("step")).alias("_clock"),
        F.col("begin_us").alias("_begin"),
        F.col("epoch_end_us").alias("_epoch_end"),
        F.col("evaluate_us").alias("_evaluate"),
        F.col("last_us").alias("_last"),
        F.col("last_step").alias("_last_step"),
        F.col("batch").alias("_batch"),
        F.col("logging_steps").alias("_k"),
    )
    return measured(runs, block)
