"""Epochs, seeded order, and full batches."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqprep.operators.ranges import ROWS_PER_RANGE, key_ranges, with_position
from seqprep.plans.storage import written

# Leading hex digits of the shuffle hash that name a bucket: 16**4 = 65,536 per epoch.
BUCKET_DIGITS = 4


def assign_batches(
    df: DataFrame,
    order_by: Sequence[str],
    batch_size: int,
    drop_last: bool = True,
    max_steps: int = -1,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``batch_id`` and ``slot`` in the order of ``order_by``; an incomplete batch is dropped.

    ``max_steps`` above 0 keeps only that many batches.
    """
    ranges = key_ranges(df, order_by, rows_per_range)
    return _batches(
        with_position(df, ranges, "_pos"), F.lit(ranges.total), batch_size, drop_last, max_steps
    ).drop("_pos")


def _batches(
    df: DataFrame, rows: Column, batch_size: int, drop_last: bool, max_steps: int
) -> DataFrame:
    size = F.lit(batch_size)
    batches = F.floor(rows / size) if drop_last else F.ceil(rows / size)
    kept = batches if max_steps <= 0 else F.least(batches, F.lit(max_steps).cast("bigint"))
    return (
        df.withColumn("batch_id", F.floor(F.col("_pos") / size).cast("bigint"))
        .withColumn("slot", (F.col("_pos") % size).cast("bigint"))
        .filter(F.col("batch_id") < kept)
    )


def train_steps(df: DataFrame, batch_size: int, epochs: int, max_steps: int = -1) -> DataFrame:
    """One row ``(rows, batches, steps)``: full batches per epoch times epochs.

    ``max_steps`` above 0 takes the place of the epochs, also where it makes the run longer; without
    a full batch there is no step.
    """
    batches = F.floor(F.col("rows") / F.lit(batch_size)).cast("bigint")
    steps = F.col("batches") * F.lit(epochs)
    if max_steps > 0:
        steps = F.when(F.col("batches") > 0, F.lit(max_steps).cast("bigint")).otherwise(F.lit(0))
    counted = df.agg(F.count("*").alias("rows")).withColumn("batches", batches)
    return counted.withColumn("steps", steps.cast("bigint"))


def with_epochs(df: DataFrame, epochs: int) -> DataFrame:
    """Every row once per epoch, with its ``epoch`` from 0: a projection, no exchange."""
    if epochs < 1:
        raise ValueError(f"expected one epoch or more, found {epochs}")
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def shuffle_hash(key: Sequence[str], seed: int) -> Column:
    """The seeded sort value of a row in its epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), "epoch", *key))


def epoch_order(
    df: DataFrame, key: Sequence[str], seed: int, bucket_digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Add ``pos``, the 0-based place of a row in its epoch's seeded order, and ``epoch_rows``.

    The leading digits of the hash cut an epoch into equal buckets in order; a row's place is the
    size of the buckets before its own plus its rank inside. The bucket sizes, at most
    ``16**bucket_digits`` (65,536) per epoch, are counted before the exchange and joined where the
    ranks are made. All columns of ``df`` are exchanged: give keys only, and see :func:`stored_batches`.
    """
    key = list(key)
    hashed = df.withColumn("_hash", shuffle_hash(key, seed)).withColumn(
        "_bucket", F.substring("_hash", 1, bucket_digits)
    )
    whole = Window.partitionBy("epoch")
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        hashed.groupBy("epoch", "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(
            "epoch",
            "_bucket",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
            F.sum("_n").over(whole).alias("epoch_rows"),
        )
    )
    rank = F.row_number().over(Window.partitionBy("epoch", "_bucket").orderBy("_hash", *key))
    return (
        hashed.withColumn("_rank", rank - 1)
        .join(sizes.hint("shuffle_hash"), ["epoch", "_bucket"])
        .withColumn("pos", F.col("_before") + F.col("_rank"))
        .drop("_hash", "_bucket", "_rank", "_before")
    )


def assign_epoch_batches(
    df: DataFrame,
    key: Sequence[str],
    batch_size: int,
    epochs: int,
    seed: int,
    drop_last: bool = True,
    max_steps: int = -1,
    bucket_digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Shuffled full batches of every epoch: ``epoch``, ``batch_id``, ``slot`` and overall ``step``.

    ``step`` counts from 1 through all epochs. ``max_steps`` above 0 takes the place of ``epochs``: the
    data is repeated until that step, where the run ends.
    """
    if max_steps > 0:
        rows = df.count()
        per_epoch = rows // batch_size if drop_last else math.ceil(rows / batch_size)
        epochs = max(1, math.ceil(max_steps / max(per_epoch, 1)))
    placed = epoch_order(with_epochs(df, epochs), key, seed, bucket_digits)
    full = F.floor(F.col("epoch_rows") / F.lit(batch_size))
    batched = _batches(
        placed.withColumnRenamed("pos", "_pos"), F.col("epoch_rows"), batch_size, drop_last, -1
    )
    per_epoch = full if drop_last else F.ceil(F.col("epoch_rows") / F.lit(batch_size))
    step = (F.col("epoch") * per_epoch + F.col("batch_id") + 1).cast("bigint")
    stepped = batched.withColumn("step", step).drop("_pos", "epoch_rows")
    return stepped.filter(F.col("step") <= max_steps) if max_steps > 0 else stepped


ROW = "row_id"
# Rows of a bucket of stored sequences.
ROWS_PER_BUCKET = 200_000


def store_sequences(df: DataFrame, table: str, path: str, rows: int | None = None) -> None:
    """Write rows once as ``table`` under ``path``, each with a ``row_id``, in buckets by it.

    Every epoch then needs keys only: the rows are read where they lie (see :func:`stored_batches`).
    """
    spark = df.sparkSession
    # Ids are given once and written down, so that they hold for every later pass.
    numbered = written(df.withColumn(ROW, F.monotonically_increasing_id()), "sequences")
    count = numbered.count() if rows is None else rows
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, math.ceil(count / ROWS_PER_BUCKET))
    (
        numbered.repartition(buckets, ROW)
        .write.mode("overwrite")
        .bucketBy(buckets, ROW)
        .sortBy(ROW)
        .option("path", path)
        .saveAsTable(table)
    )


def stored_batches(
    spark: SparkSession,
    table: str,
    key: Sequence[str],
    batch_size: int,
    epochs: int,
    seed: int,
    drop_last: bool = True,
    max_steps: int = -1,
    bucket_digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """:func:`assign_epoch_batches` of stored rows, where an epoch exchanges an index of keys only.

    The index has a row per epoch and stored row: its id, and the batch, slot and step. It is exchanged
    into the buckets of the table; the sequences themselves are never exchanged.
    """
    rows = spark.table(table)
    keys = rows.select(ROW, *[k for k in key if k != ROW])
    index = assign_epoch_batches(keys, key, batch_size, epochs, seed, drop_last, max_steps, bucket_digits)
    index = index.select(ROW, "epoch", "batch_id", "slot", "step")
    return rows.join(index.hint("merge"), ROW).drop(ROW)
