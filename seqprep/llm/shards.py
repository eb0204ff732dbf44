"""Shards by a two-pass external shuffle, in DataFrame functions only.

Law ``key``: the shard is the one whose seeded hash with ``doc_id`` is the largest of all shards, so
with one more shard a row stays or moves into the new one. The first pass scatters the rows of a
shard over buckets of about ``BUCKET_ROWS`` rows by another seeded hash; the second sorts a bucket's
rows, shuffles them by Fisher and Yates (inside-out form, draws from a seeded hash of shard, bucket
and step), and numbers them on from the rows of the buckets before. Every draw depends on data and
seed alone, so a task that runs again gives the same rows. Only row counts and places are held in
arrays; the rows themselves are exchanged once and stay rows. Repeated rows share a bucket; one that
they fill beyond ``PART_ROWS`` rows is dealt in parts, which does not show, as they are equal.

Defined results: a NULL text counts as empty; rows without an id share a shard; repeated rows each
get a slot. An empty table gives no rows. Carried columns keep their names, except that those named
as the results are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from seqprep.llm.frames import free, written

SHARDS = 24
SEED = 20_240_611
#: Rows of a bucket on average; a bucket is held and shuffled in one row.
BUCKET_ROWS = 256
ROW_BYTES = 8

#: Rows shuffled in one array: a bucket that equal rows fill beyond it is dealt in parts.
PART_ROWS = 1024
#: Buckets that one task shuffles.
TASK_BUCKETS = 2000


def shard_of(shards: int, seed: int = SEED) -> Column:
    """The shard of ``doc_id`` among ``shards``."""
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.struct(F.xxhash64(F.lit(seed), "doc_id", s).alias("h"), s.alias("s")),
    )
    return F.array_max(draws)["s"]


def _shuffled(
    count: Column, shard: Column, bucket: Column, seed: int, part: Column | None = None
) -> Column:
    """A permutation of ``0 .. count - 1``: each step swaps the newcomer with one before it."""

    own = F.lit(seed + 2) + (F.lit(0) if part is None else part)

    def step(order: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(own, shard, bucket, i), (i + 1).cast("bigint")).cast("int")
        swapped = F.concat(
            F.slice(order, F.lit(1), j),
            F.array(i),
            F.slice(order, j + 2, i - j - 1),
            F.array(F.get(order, j)),
        )
        return F.when(j == i, F.concat(order, F.array(i))).otherwise(swapped)

    return F.aggregate(F.sequence(F.lit(0), count - 1), F.array().cast("array<int>"), step)


def shards(docs: DataFrame, carry: bool = False, count: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Each row's ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``.

    ``doc_id`` comes along, and with ``carry`` all columns of ``docs``.
    """
    results = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    other = [c for c in docs.columns if carry and c.lower() not in [*results, "doc_id"]]
    names = free(docs, "_to_shard", "_to_bucket", "_rank", "_tie", "_start", "_order", "_n")
    shard, bucket, rank, tie, start, order, n = names
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.crc32(data).alias("text_crc32"),
        (F.octet_length(data) + ROW_BYTES).cast("bigint").alias("size"),
        *other,
        F.xxhash64(data, *[F.col(c) for c in other]).alias(tie),
    )
    buckets = max(1, math.ceil(docs.count() / (count * BUCKET_ROWS)))
    place = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "text_crc32", "size"), F.lit(buckets))
    scattered = rows.withColumn(shard, shard_of(count, seed)).withColumn(bucket, place)
    starts = _starts(scattered.select(shard, bucket), [shard, bucket, n, start, order], buckets * count, seed)
    inside = Window.partitionBy(shard, bucket).orderBy("doc_id", "text_crc32", "size", tie)
    ranked = scattered.withColumn(rank, F.row_number().over(inside) - 1)
    moved = ranked.join(starts.hint("shuffle_hash"), [shard, bucket])
    parts = F.size(order)
    part, at = F.col(rank) % parts, F.floor(F.col(rank) / parts).cast("int")
    slot = F.col(start) + _before(F.col(n), parts, part) + F.get(F.get(order, part), at)
    return moved.select(
        "doc_id",
        *other,
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col(shard).alias("shard"),
        slot.cast("bigint").alias("slot"),
        shard_of(count + 1, seed).alias("grown_shard"),
    )


def _before(n: Column, parts: Column, part: Column) -> Column:
    """Rows in the parts of a bucket before ``part``, its rows being dealt in turn."""
    return part * F.floor(n / parts) + F.least(part, n % parts)


def _starts(scattered: DataFrame, names: list[str], buckets: int, seed: int) -> DataFrame:
    """Of each bucket, the rows of its shard before it and the shuffled places of its own.

    A bucket that equal rows make large is dealt in parts, each shuffled by itself. Buckets are spread
    by their number, as their counts are few bytes for much work.
    """
    shard, bucket, n, start, order = names
    sizes = scattered.groupBy(shard, bucket).agg(F.count("*").alias(n))
    earlier = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn(start, F.coalesce(F.sum(n).over(earlier), F.lit(0)))
    sizes = sizes.repartition(max(1, math.ceil(buckets / TASK_BUCKETS)), shard, bucket)
    parts = F.ceil(F.col(n) / PART_ROWS).cast("int")
    shuffled = F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda part: _shuffled(
            (_before(F.col(n), parts, part + 1) - _before(F.col(n), parts, part)).cast("int"),
            F.col(shard),
            F.col(bucket),
            seed,
            part,
        ),
    )
    return written(sizes.select(shard, bucket, n, start, shuffled.alias(order)), "buckets")


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Write shards as folders of Parquet files, each file a run of slots in order."""
    run = F.floor(F.col("slot") / rows_per_file)
    placed = sharded.withColumn("_run", run).repartition("shard", "_run")
    placed.sortWithinPartitions("shard", "slot").drop("_run").write.partitionBy("shard").parquet(path)
