"""Clock records of an event stream, each with the one before it, from keyed state with timers.

State is kept per span of time and group of runs, whose number is fixed, in a RocksDB store: one entry
per record that waits, a count per tick of time, and per run the record that left last. No entry holds
more than one record, whatever the size of a span or a run. What a key costs by itself (its frames and
its timers, several milliseconds) does not grow with the number of runs; a record costs one call to
the store as it comes, and calls that read or remove many entries as it leaves.

A timer at the end of a tick wakes the key when the watermark has passed it; the records of all ticks
that have passed then leave, those of a run in order of (time, seq). Another timer at the span's end
forgets the key.

No record is dropped. Spark filters rows behind the watermark only where the operator sees the event
time column, so it is given the time as a number, and a record whose tick has left already comes out
at once, marked ``late``. What follows takes late records from there (see ``throughput`` and
``incremental``). State lives in the query's checkpoint, so a restarted query goes on where it was; the
lengths of span and tick and the number of groups belong to it.

A NULL ``run_id`` is a run; records without a time are no clock records. Time to live is not used: Spark
offers it for processing time only.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from seqprep.functions.scalars import MICROS
from seqprep.operators.run_state import interval_sums, is_warm_up
from seqprep.operators.shaping import require_columns
from seqprep.operators.telemetry import EVENT_SCHEMA, is_clock_record, is_interval

SPAN_SECONDS = 3_600
#: Records of one tick leave together; a longer tick wakes a key less often.
TICK_SECONDS = 1
#: Groups of runs; all tasks have work as long as there are several groups for each.
RUN_GROUPS = 256
#: Records of a key that are held in memory together; of a larger key, those of a tick.
AT_ONCE = 100_000

FIELDS = ("us", "seq", "step", "loss", "learning_rate", "yields", "warms")
_RECORD = (
    "us bigint, seq bigint, step bigint, loss double, learning_rate double, yields boolean, warms boolean"
)
#: What may be NULL travels as a value and whether it is one: one NULL would make floats of a frame's numbers.
_NULLABLE = ("run_id", "seq", "step", "loss", "learning_rate")
_REAL = ("loss", "learning_rate")
_LEFT = "before_us bigint, before_step bigint, late boolean, at timestamp"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class HeldRecords(StatefulProcessor):
    """The state of one group of runs in one span."""

    def __init__(self, span_ms: int, tick_ms: int, run_kind: str) -> None:
        self.span_ms, self.tick_ms, self.run_kind = span_ms, tick_ms, run_kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        run = f"run_id {self.run_kind}"
        # A record is one text: fields cost their conversions on both sides of each call.
        self.held = handle.getMapState("held", "tick bigint, place int", "record string")
        self.counts = handle.getMapState("counts", "tick bigint", "n int")
        self.clock = handle.getMapState("clock", run, "us bigint, step bigint")

    def handleInputRows(self, key: tuple, rows: Iterable[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """Keep what the watermark has not passed; give the rest out as late."""
        watermark = timerValues.getCurrentWatermarkInMs()
        counts: dict[int, int] = {}
        for batch in rows:
            late = []
            for record in _records(batch):
                tick = self._tick(record)
                if self._has_passed(tick, watermark):
                    late.append((*record, None, None, True))
                    continue
                if tick not in counts:
                    before = self.counts.getValue((tick,))
                    counts[tick] = before[0] if before else 0
                    if not before:
                        self.handle.registerTimer((tick + 1) * self.tick_ms)
                self.held.updateValue((tick, counts[tick]), (json.dumps(record),))
                counts[tick] += 1
            if late:
                yield self._frame(key, late)
        for tick, n in counts.items():
            self.counts.updateValue((tick,), (n,))
        if counts:
            self.handle.registerTimer(self._end(key) + 1)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Give out all ticks that have passed, or forget the span."""
        expired, watermark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        if expired == self._end(key) + 1:
            self.clock.clear()
            return
        if not self.counts.containsKey((expired // self.tick_ms - 1,)):
            return  # left with an earlier tick
        counts = {tick: n for (tick,), (n,) in self.counts.iterator()}
        clock = {run: last for (run,), last in self.clock.iterator()}
        changed = set()
        for records in self._leaving(counts, watermark):
            out = []
            for record in sorted(records, key=_order):
                run = record[0]
                out.append((*record, *clock.get(run, (None, None)), False))
                clock[run] = (record[1], record[3])
                changed.add(run)
            yield self._frame(key, out)
        # Nothing follows in a span whose own timer is due as well.
        if self._end(key) + 1 >= watermark:
            for run in changed:
                self.clock.updateValue((run,), clock[run])

    def close(self) -> None:
        pass

    def _tick(self, record: tuple) -> int:
        return record[1] // 1_000 // self.tick_ms

    def _has_passed(self, tick: int, watermark: int) -> bool:
        return (tick + 1) * self.tick_ms <= watermark

    def _leaving(self, counts: dict[int, int], watermark: int) -> Iterator[list[tuple]]:
        """The records of ticks that have passed, taken out of the state; each list lies behind the one before."""
        passed = sorted(tick for tick in counts if self._has_passed(tick, watermark))
        n, total = sum(counts[tick] for tick in passed), sum(counts.values())
        if total <= AT_ONCE and 2 * n >= total:
            ticks = set(passed)
            found = [record for record in map(_record, self.held.values()) if self._tick(record) in ticks]
            if n == total:
                self.held.clear()
                self.counts.clear()
            else:
                self._forget([(tick, i) for tick in passed for i in range(counts[tick])], passed)
            yield found
            return
        for tick in passed:
            places = [(tick, i) for i in range(counts[tick])]
            records = [_record(self.held.getValue(at)) for at in places]
            self._forget(places, [tick])
            yield records

    def _forget(self, places: list[tuple[int, int]], ticks: list[int]) -> None:
        for at in places:
            self.held.removeKey(at)
        for tick in ticks:
            self.counts.removeKey((tick,))

    def _end(self, key: tuple) -> int:
        """The span's end, a multiple of the tick."""
        return (key[1] + 1) * self.span_ms

    def _frame(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        names = ["run_id", *FIELDS, "before_us", "before_step", "late"]
        columns = dict(zip(names, zip(*rows)))
        frame = {}
        for name, values in columns.items():
            if name in _REAL:
                # A loss that is not a number is not a missing one.
                frame[name] = pd.array(pa.array(values, pa.float64()), dtype=pd.ArrowDtype(pa.float64()))
            elif name in ("yields", "warms", "late"):
                frame[name] = pd.array(values, dtype="boolean")
            elif name == "run_id" and self.run_kind == "string":
                frame[name] = pd.Series(values, dtype=object)
            else:
                frame[name] = pd.array(values, dtype="Int64")
        frame["span"] = key[1]
        frame["at"] = pd.to_datetime(list(columns["us"]), unit="us", utc=True)
        return pd.DataFrame({name: frame[name] for name in ("run_id", "span", *names[1:], "at")})


def _record(held: tuple) -> tuple:
    """A record from its text."""
    return tuple(json.loads(held[0]))


def _order(record: tuple) -> tuple:
    """(time, seq), NULL first."""
    return record[1], record[2] is not None, record[2] or 0


def _records(batch: pd.DataFrame) -> Iterator[tuple]:
    """Plain values of the rows, the run first, with None for what is missing; a loss may be NaN."""
    columns = []
    for name in ("run_id", *FIELDS):
        values = batch[name].tolist()
        if name in _NULLABLE:
            values = [v if has else None for v, has in zip(values, batch[f"has_{name}"].tolist())]
        elif batch[name].isna().any():
            values = [None if pd.isna(v) else v for v in values]
        columns.append(values)
    return zip(*columns)


@contextmanager
def rocks_store(spark: SparkSession) -> Iterator[None]:
    """While a query starts: the state store that entries of their own need."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)


def record_stream(
    events: DataFrame,
    logging_steps: int,
    delay: str,
    span_seconds: int = SPAN_SECONDS,
    tick_seconds: int = TICK_SECONDS,
    event_time: bool = False,
    run_groups: int = RUN_GROUPS,
) -> DataFrame:
    """Clock records of the stream ``events`` as they pass the watermark, and late ones as they come.

    Columns ``run_id, span``, those of a record, ``before_us, before_step`` (of the record before in
    the same span), ``late`` and the time as ``at``. Every event moves the watermark. With
    ``event_time`` the time is one that an aggregate behind may use. Start the query in
    :func:`rocks_store`.
    """
    require_columns(events, EVENT_SCHEMA)
    if span_seconds % tick_seconds:
        raise ValueError("a span is a whole number of ticks")
    kind = events.schema["run_id"].dataType.simpleString()
    kind = kind if kind == "string" else "bigint"
    # The filter names the event time, so that it stays behind the watermark.
    clock = events.withWatermark("ts", delay).filter(
        F.when(F.col("ts").isNotNull(), is_clock_record(logging_steps))
    )
    run, us, width = F.col("run_id").cast(kind), F.unix_micros("ts"), F.lit(span_seconds * MICROS)
    rows = clock.select(
        F.pmod(F.xxhash64(run), F.lit(run_groups)).cast("int").alias("_group"),
        F.coalesce(run, F.lit(0).cast(kind)).alias("run_id"),
        run.isNotNull().alias("has_run_id"),
        ((us - F.pmod(us, width)) / width).cast("bigint").alias("span"),
        us.alias("us"),
        *[F.coalesce(name, F.lit(0)).cast(events.schema[name].dataType).alias(name) for name in _NULLABLE[1:]],
        *[F.col(name).isNotNull().alias(f"has_{name}") for name in _NULLABLE[1:]],
        is_interval().alias("yields"),
        is_warm_up().alias("warms"),
    )
    return rows.groupBy("_group", "span").transformWithStateInPandas(
        HeldRecords(span_seconds * 1_000, tick_seconds * 1_000, kind),
        f"run_id {kind}, span bigint, {_RECORD}, {_LEFT}",
        "Append",
        "eventTime",
        eventTimeColumnName="at" if event_time else "",
    )


def span_report_stream(
    events: DataFrame,
    logging_steps: int,
    delay: str,
    span_seconds: int = SPAN_SECONDS,
    tick_seconds: int = TICK_SECONDS,
) -> DataFrame:
    """Sums of the intervals inside each run and span, once the span is over: an aggregate behind the state.

    A live report; it leaves out late records and the interval into a span, which the written tables have.
    """
    records = record_stream(events, logging_steps, delay, span_seconds, tick_seconds, event_time=True)
    on_time = records.filter("not late")
    sums = on_time.groupBy("run_id", F.window("at", f"{span_seconds} seconds")).agg(
        *interval_sums(
            F.col("us") - F.col("before_us"),
            F.col("step") - F.col("before_step"),
            F.col("yields"),
            F.col("warms"),
        )
    )
    return sums.select(
        "run_id",
        F.col("window.start").alias("span_start"),
        "intervals",
        "sum_us",
        F.try_divide("rates", F.col("rated").cast("double")).alias("steps_per_second"),
    )
