"""Interval throughput of training events that arrive as a stream, in any order.

State is kept per run *and* span of time, so a run of any size is folded by many tasks, and one
state never holds more than a span. Clock records leave the state behind the watermark, each with
the clock record before it in its span; the first record of a span gets its predecessor from the
last record of the run's span before, when the written table is read. The sink is a parquet file
sink: a retried batch never shows twice. Records that came late lie beside the others, and their
spans are put in order again when the table is read.
"""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seqprep.functions.scalars import MICROS, seconds
from seqprep.operators.telemetry import (
    EVENT_SCHEMA,
    is_clock_record,
    is_interval,
    tokens_per_second,
)
from seqprep.operators.shaping import require_columns
from seqprep.streaming.records import SPAN_SECONDS, TICK_SECONDS, record_stream, rocks_store

FIELDS = ["us", "seq", "step", "loss", "learning_rate", "yields"]


def _clock_records(events: DataFrame, logging_steps: int, delay: str) -> DataFrame:
    """Clock records behind a watermark that every event moves on.

    The condition refers to the event time, so Spark does not filter before the watermark.
    """
    require_columns(events, EVENT_SCHEMA)
    return (
        events.withWatermark("ts", delay)
        .filter(F.when(F.col("ts").isNotNull(), is_clock_record(logging_steps)))
        .withColumn("us", F.unix_micros("ts"))
        .withColumn("yields", is_interval())
    )


def clock_stream(
    events: DataFrame, logging_steps: int, delay: str, span_seconds: int = SPAN_SECONDS
) -> DataFrame:
    """Clock records with the one before each, a whole span at a time, in append mode.

    A span leaves the state once the watermark has passed its end. State and fold are Spark's own
    windowed aggregation.
    """
    clock = _clock_records(events, logging_steps, delay)
    records = F.sort_array(F.collect_list(F.struct(*FIELDS)))
    spans = clock.groupBy("run_id", F.window("ts", f"{span_seconds} seconds")).agg(
        records.alias("_records")
    )

    def with_before(record: Column, at: Column) -> Column:
        before = F.get(F.col("_records"), at - 1)
        return F.struct(
            *[record[name].alias(name) for name in FIELDS],
            before["us"].alias("before_us"),
            before["step"].alias("before_step"),
        )

    span = F.floor(F.unix_micros("window.start") / (span_seconds * MICROS)).cast("bigint")
    return spans.select(
        "run_id", span.alias("span"), F.inline(F.transform("_records", with_before))
    )


def stream_throughput(
    events: DataFrame,
    logging_steps: int,
    delay: str,
    path: str,
    span_seconds: int = SPAN_SECONDS,
    by_record: bool = False,
    tick_seconds: int = TICK_SECONDS,
) -> StreamingQuery:
    """Start the stream for what is available now; clock records are appended under ``path``.

    Records closer than ``delay`` to the newest event stay in the state until later events move
    the watermark on. ``by_record`` releases each record by itself and keeps late ones; without it a
    span leaves as a whole, by Spark's own windowed aggregation, and late records are an error.
    """
    if by_record:
        rows = record_stream(events, logging_steps, delay, span_seconds, tick_seconds).drop("at")
    else:
        rows = clock_stream(events, logging_steps, delay, span_seconds)
    sink = (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{path}/clock")
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
    )
    with rocks_store(events.sparkSession) if by_record else nullcontext():
        return sink.start()


def finish(query: StreamingQuery, poll_seconds: int = 5) -> None:
    """Wait for the query; raise if records arrived too late and were dropped."""
    dropped: dict[int, int] = {}
    done = False
    while not done:
        done = query.awaitTermination(poll_seconds)
        for progress in query.recentProgress:
            dropped[progress.batchId] = max(
                dropped.get(progress.batchId, 0),
                sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators),
            )
    late = sum(dropped.values())
    if late:
        raise RuntimeError(f"{late} records arrived after the watermark; use a longer delay")


def mended(rows: DataFrame) -> DataFrame:
    """Written records, with the record before each found anew in spans that got late ones.

    Only those spans of those runs are put in order again; the others are passed as they are.
    """
    key = [F.col("run_id").alias("_run"), F.col("span").alias("_span")]
    touched = rows.filter("late").select(*key, F.lit(True).alias("_mend")).distinct()
    same = F.col("run_id").eqNullSafe(F.col("_run")) & (F.col("span") == F.col("_span"))
    marked = rows.join(touched, same, "left").drop("_run", "_span")
    order = Window.partitionBy("run_id", "span").orderBy("us", "seq")
    again = marked.filter("_mend").withColumns(
        {"before_us": F.lag("us").over(order), "before_step": F.lag("step").over(order)}
    )
    return marked.filter("_mend is null").unionByName(again).drop("_mend", "late")


def stream_intervals(spark: SparkSession, path: str, block: int, batch: int) -> DataFrame:
    """Interval rows of the clock records written so far."""
    rows = spark.read.parquet(f"{path}/clock")
    rows = mended(rows) if "late" in rows.columns else rows
    last = rows.groupBy("run_id", "span").agg(F.max(F.struct("us", "seq", "step")).alias("_last"))
    carried = last.select(
        "run_id", "span", F.lag("_last").over(Window.partitionBy("run_id").orderBy("span")).alias("_c")
    )
    inner = rows.filter(F.col("before_us").isNotNull())
    carried = carried.withColumnsRenamed({"run_id": "_run", "span": "_span"})
    same = F.col("run_id").eqNullSafe(F.col("_run")) & (F.col("span") == F.col("_span"))
    first = rows.filter(F.col("before_us").isNull()).join(carried, same, "left").drop("_run", "_span")
    first = first.withColumns({"before_us": F.col("_c.us"), "before_step": F.col("_c.step")})
    timed = inner.unionByName(first.drop("_c")).filter("yields")
    steps = F.col("step") - F.col("before_step")
    elapsed = seconds(F.col("us") - F.col("before_us"))
    return timed.select(
        "run_id",
        "seq",
        "step",
        F.timestamp_micros("us").alias("ts"),
        "loss",
        "learning_rate",
        steps.alias("steps"),
        elapsed.alias("seconds"),
        tokens_per_second(block, batch, steps, elapsed).alias("tps"),
        F.try_divide(elapsed, steps.cast("double")).alias("seconds_per_step"),
    )


def stream_summary(intervals: DataFrame, logging_steps: int) -> DataFrame:
    """Running figures per run over the intervals written so far."""
    divisor = (F.col("intervals") * F.lit(logging_steps) - 1).cast("double")
    sums = intervals.groupBy("run_id").agg(
        F.count("*").alias("intervals"),
        F.avg("tps").alias("avg_tps"),
        F.sum(F.round(F.col("seconds") * MICROS).cast("bigint")).alias("_us"),
    )
    return sums.withColumn("avg_step_seconds", F.try_divide(seconds(F.col("_us")), divisor)).drop(
        "_us"
    )
