"""A run report that is kept up to date: every micro-batch adds what it brought.

The stream is written by ``foreachBatch`` in tables of one folder per batch, so that a batch run again
after a failure replaces what it wrote and adds nothing twice:

- ``records``: the clock records that the batch released, and late ones;
- ``states``: a state per run and span of the batch's records (see ``operators.run_state``), and a
  whole new one for each span that a late record fell into;
- ``totals``: one state per run after the batch, written last.

What leaves the watermark in a batch lies behind everything that left before, so a batch's states are the
next stretch of their runs, and totals are the totals of the batch before plus these. A batch reads its
own records, one row per run, and, only for runs with late records, the records of the spans concerned
and the states of the runs. The report is read from the last finished ``totals``; older ones are removed.

Facts that need no order (begin, ends, last event) are taken from all events as they arrive, so the report
is that of ``run_summary`` over all events whose clock records have been released.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from seqprep.operators.run_state import (
    clock_states,
    ends_of_stretch,
    facts,
    interval_sums,
    known_states,
    merge_states,
    state_summary,
)
from seqprep.operators.telemetry import Number, _col
from seqprep.plans.storage import is_complete, list_names, remove
from seqprep.streaming.records import SPAN_SECONDS, TICK_SECONDS, record_stream, rocks_store

RECORDS, STATES, TOTALS = "records", "states", "totals"
#: Totals of finished batches that stay; a retried batch needs the one before it.
KEPT_TOTALS = 3


def _folder(path: str, table: str, batch_id: int) -> str:
    return f"{path}/{table}/of_batch={batch_id}"


def _same_run(other: str = "_run") -> Column:
    return F.col("run_id").eqNullSafe(F.col(other))


def _states_of(rows: DataFrame) -> DataFrame:
    """A state per run and span of clock records; what lies outside ``rows`` is left to merging."""
    order = Window.partitionBy("run_id", "span").orderBy("us", "seq")
    us, steps = F.col("us") - F.lag("us").over(order), F.col("step") - F.lag("step").over(order)
    rows = rows.select("run_id", "span", "us", "seq", "step", "yields", "warms", us.alias("_us"), steps.alias("_steps"))
    sums = rows.groupBy("run_id", "span").agg(
        *ends_of_stretch(F.lit(True)),
        *interval_sums(F.col("_us"), F.col("_steps"), F.col("yields"), F.col("warms")),
    )
    return clock_states(sums, ["span"])


class RunTotals:
    """The tables under ``path``: how a batch is merged into them, and what they say."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def merge(self, rows: DataFrame, batch_id: int) -> None:
        """Add one micro-batch of :func:`updates`; again with the same ``batch_id`` it replaces itself."""
        spark, folder = self.spark, lambda table: _folder(self.path, table, batch_id)
        rows.write.mode("overwrite").parquet(folder(RECORDS))
        rows = spark.read.schema(rows.schema).parquet(folder(RECORDS))
        clock = rows.filter("kind is null")
        fresh = _states_of(clock.filter("not late"))
        # One pass without an exchange says whether there are late records and where.
        low, high = clock.filter("late").agg(F.min("span"), F.max("span")).first()
        has_late = low is not None
        if has_late:
            mended = self._mended(rows.schema, low, high, batch_id)
            late = clock.filter("late").select(F.col("run_id").alias("_run"), F.col("span").alias("_span")).distinct()
            again = _same_run() & (F.col("span") == F.col("_span"))
            fresh = fresh.join(late, again, "left_anti").withColumn("mended", F.lit(False))
            fresh = fresh.unionByName(mended.withColumn("mended", F.lit(True)))
        else:
            fresh = fresh.withColumn("mended", F.lit(False))
        fresh.write.mode("overwrite").parquet(folder(STATES))
        fresh = spark.read.schema(fresh.schema).parquet(folder(STATES))
        told = rows.filter("kind is not null").groupBy("run_id").agg(
            *facts(F.col("kind"), F.col("us"), F.col("step"), F.col("batch"), F.col("logging_steps"))
        )
        parts = [known_states(told)]
        before = self._totals(batch_id - 1) if batch_id else None
        if has_late:
            # Each span with a late record has a mended state.
            runs = fresh.filter("mended").select(F.col("run_id").alias("_run")).distinct()
            parts.append(self._effective(fresh.schema, batch_id).join(runs, _same_run(), "left_semi").drop("span"))
            parts.append(fresh.join(runs, _same_run(), "left_anti").drop("span", "mended"))
            if before is not None:
                parts.append(before.join(runs, _same_run(), "left_anti"))
                parts.append(known_states(before.join(runs, _same_run(), "left_semi")))
        else:
            parts.append(fresh.drop("span", "mended"))
            parts += [before] if before is not None else []
        merge_states(parts).write.mode("overwrite").parquet(folder(TOTALS))
        remove(spark, _folder(self.path, TOTALS, batch_id - KEPT_TOTALS))

    def _upto(self, table: str, schema: StructType, batch_id: int) -> DataFrame:
        """The table's rows of all batches up to this one."""
        rows = self.spark.read.schema(StructType([*schema, StructField("of_batch", IntegerType())]))
        return rows.parquet(f"{self.path}/{table}").filter(F.col("of_batch") <= batch_id)

    def _mended(self, schema: StructType, low: int, high: int, batch_id: int) -> DataFrame:
        """States of the whole spans that got late records, from all their records so far.

        Batches are stretches of time, so the bounds of the spans leave out most files of the records. The
        rows are exchanged once: the spans concerned are found where their records are put in order.
        """
        rows = self._upto(RECORDS, schema, batch_id)
        rows = rows.filter(F.col("span").between(low, high) & F.col("kind").isNull())
        came_late = F.max(F.col("late") & (F.col("of_batch") == batch_id))
        rows = rows.withColumn("_mend", came_late.over(Window.partitionBy("run_id", "span")))
        return _states_of(rows.filter("_mend"))

    def _effective(self, schema: StructType, batch_id: int) -> DataFrame:
        """The states that hold after a batch: of a span from its latest mended one on."""
        rows = self._upto(STATES, schema, batch_id)
        per_span = Window.partitionBy("run_id", "span")
        rows = rows.withColumn("_from", F.max(F.when(F.col("mended"), F.col("of_batch"))).over(per_span))
        kept = rows.filter(F.col("_from").isNull() | (F.col("of_batch") >= F.col("_from")))
        # Without its number the stretch is known by its records alone.
        return clock_states(kept, ["span"])

    def _totals(self, batch_id: int) -> DataFrame:
        folder = _folder(self.path, TOTALS, batch_id)
        if not is_complete(self.spark, folder):
            raise RuntimeError(f"batch {batch_id} left no totals under {self.path}; start with a new folder")
        return self.spark.read.parquet(folder)

    def last_batch(self) -> int | None:
        """The last batch whose totals are finished."""
        found = [int(n.partition("=")[2]) for n in list_names(self.spark, f"{self.path}/{TOTALS}")]
        done = [i for i in found if is_complete(self.spark, _folder(self.path, TOTALS, i))]
        return max(done, default=None)

    def summary(self, block: Number) -> DataFrame:
        """The report of all runs, from one row each."""
        last = self.last_batch()
        if last is None:
            raise RuntimeError(f"no finished batch under {self.path}")
        return state_summary(self._totals(last), block)


def updates(
    events: DataFrame,
    logging_steps: int,
    batch: Number,
    delay: str,
    span_seconds: int = SPAN_SECONDS,
    tick_seconds: int = TICK_SECONDS,
) -> DataFrame:
    """What a batch brings: released clock records, and every event as a fact (``kind`` is set)."""
    clock = record_stream(events, logging_steps, delay, span_seconds, tick_seconds).drop("at")
    known = events.filter(F.col("ts").isNotNull()).select(
        F.col("run_id").cast(clock.schema["run_id"].dataType).alias("run_id"),
        F.unix_micros("ts").alias("us"),
        "step",
        F.coalesce("kind", F.lit("")).alias("kind"),
        _col(batch).cast("bigint").alias("batch"),
        F.lit(logging_steps).cast("bigint").alias("logging_steps"),
    )
    return clock.unionByName(known, allowMissingColumns=True)


def stream_summary_incremental(
    events: DataFrame,
    logging_steps: int,
    batch: Number,
    delay: str,
    path: str,
    span_seconds: int = SPAN_SECONDS,
    tick_seconds: int = TICK_SECONDS,
) -> StreamingQuery:
    """Start the stream for what is available now; totals are kept under ``path``.

    One query writes to a ``path`` at a time. Its progress lies beside the tables, so that a started
    query goes on with the batch after the last finished one, or runs an unfinished one again.
    """
    totals = RunTotals(events.sparkSession, path)
    rows = updates(events, logging_steps, batch, delay, span_seconds, tick_seconds)
    with rocks_store(events.sparkSession):
        return (
            rows.writeStream.foreachBatch(lambda found, batch_id: totals.merge(found, batch_id))
            .outputMode("append")
            .option("checkpointLocation", f"{path}/progress")
            .trigger(availableNow=True)
            .start()
        )
