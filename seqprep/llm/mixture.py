"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Each source is a queue of its documents in a seeded random order, twice over. An entry's virtual
finish time is the words of its source up to and with it, divided by the source's target. Entries of
all sources in order of finish time are taken while their words fit the total budget; a source's
words are then near its target wherever the cut falls.

Running sums never need one task: a source is cut into runs of its order, the merged order into
equal spans of finish time, which hold about equal numbers of words by construction, and only sums
per run or span cross a border.

Defined results: sources in code point order, NULL last, weigh 5, 2, 1 and so on; a NULL or wordless
text has size 0 and takes nothing, also where its whole source is such; repeated rows each queue; rows without an id are ordered first.
An empty table gives no rows. No other columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from seqprep.llm.frames import WORD, free, written
from seqprep.operators.ranges import key_ranges, with_position

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
SEED = 7
#: Words of a span of finish time, and rows of a run of a source.
SPAN_WORDS = 1_000_000
RUN_ROWS = 5_000


def sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Per row ``doc_id``, ``source``, its words as ``size``, and its place ``draw`` in the shuffle."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        _size(docs).alias("size"),
        _draw(F.col("doc_id"), seed).alias("draw"),
    )


def _size(docs: DataFrame) -> Column:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def _draw(doc_id: Column, seed: int) -> Column:
    """Random digits that order a source's queue, the same in every run."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("bigint").cast("string")).cast("binary"))


def targets(rows: DataFrame) -> DataFrame:
    """``(source, rank, source_size, target)``: shares by weight, none above its source's limit.

    A share above the limit is set to it and the excess is shared anew by weight; each turn costs
    one row of sums at the driver and settles at least one source.
    """
    sources = written(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    last = sources.select("*", F.col("source").isNull().alias("_last"))
    ranked = with_position(last, key_ranges(last, ["_last", "source"]), "rank").drop("_last")
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    ranked = ranked.withColumn("weight", F.get(weights, (F.col("rank") % len(WEIGHTS)).cast("int")))
    ranked = written(ranked.withColumn("limit", F.col("source_size") * REPEATS), "ranked")
    budget = SHARE * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    settled, left, weight = F.lit(False), budget, 0
    while True:
        open_ = ranked.filter(~settled).agg(F.sum("weight")).first()[0] or 0
        held = ranked.filter(settled).agg(F.sum("limit")).first()[0] or 0
        if (left, weight) == (budget - held, open_) or not open_:
            break
        left, weight = budget - held, open_
        settled = F.col("limit") * weight < F.col("weight") * left
    share = F.col("weight") * F.lit(float(left)) / F.lit(float(max(weight, 1)))
    target = F.when(settled, F.col("limit").cast("double")).otherwise(share)
    return ranked.select("source", "rank", "source_size", target.alias("target"))


def _running(rows: DataFrame, group: list[str], run: str, order: list[str], name: str) -> DataFrame:
    """Add the running sum of ``size`` in ``group`` by ``run``, then ``order``."""
    inside = Window.partitionBy(*group, run).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy(*group, run).agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy(*group).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, run, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    summed = rows.withColumn(name, F.sum("size").over(inside)).join(sums, [*group, run])
    return summed.withColumn(name, F.col(name) + F.col("_before")).drop("_before")


def queued(rows: DataFrame) -> DataFrame:
    """``rows`` with their source's figures and ``first`` and ``second``, the virtual finish times."""
    named = targets(rows).withColumnRenamed("source", "_source")
    joined = rows.join(named, rows["source"].eqNullSafe(named["_source"])).drop("_source")
    runs = max(1, math.ceil(rows.count() / RUN_ROWS))
    part = F.conv(F.substring("draw", 1, 8), 16, 10).cast("double") / 2.0**32
    joined = joined.withColumn("_run", F.floor(part * runs).cast("int"))
    summed = _running(joined, ["rank"], "_run", ["draw", "doc_id", "size"], "_sum")
    return summed.select(
        *rows.columns,
        "rank",
        "source_size",
        "target",
        _over(F.col("_sum")).alias("first"),
        _over(F.col("_sum") + F.col("source_size")).alias("second"),
    )


def _over(words: Column) -> Column:
    """``words`` by the target; 0 in a source without words, whose target is 0."""
    return F.coalesce(F.try_divide(words.cast("double"), F.col("target")), F.lit(0.0))


def _entry(turn: int) -> Column:
    """What orders the entries: finish time, then ties."""
    finish = F.col("second") if turn else F.col("first")
    return F.struct(
        finish.alias("finish"), "rank", F.lit(turn).alias("turn"), "draw", "doc_id", "size"
    )


def mix(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, turns and order."""
    rows = written(queued(written(sizes(docs), "sizes")), "queues")
    total = rows.agg(F.sum("size")).first()[0] or 0
    budget, spans = SHARE * total, max(1, math.ceil(SHARE * total / SPAN_WORDS))
    entries = rows.filter("size > 0").select(F.explode(F.array(_entry(0), _entry(1))).alias("entry"))
    span = F.floor(F.least(F.col("entry.finish"), F.lit(2.0)) * spans).cast("int")
    entries = entries.select("entry", F.col("entry.size").alias("size"), span.alias("span"))
    sums = entries.groupBy("span").agg(F.sum("size").alias("n"))
    upto = sums.withColumn("upto", F.sum("n").over(Window.orderBy("span")))
    edge = upto.filter(F.col("upto") > budget).orderBy("span").first()
    cut = F.lit(True), F.lit(True)
    if edge is not None:
        inside = Window.partitionBy("span").orderBy("entry").rowsBetween(Window.unboundedPreceding, 0)
        near = entries.filter(F.col("span") == edge["span"]).withColumn("upto", F.sum("size").over(inside))
        fits = near.filter(F.col("upto") + (edge["upto"] - edge["n"]) <= budget)
        last = fits.agg(F.max("entry").alias("entry")).first()["entry"]
        if last is None:
            cut = tuple(_finish(turn) * spans < edge["span"] for turn in (0, 1))
        else:
            at = F.struct(
                F.lit(last["finish"]).alias("finish"),
                F.lit(last["rank"]).alias("rank"),
                F.lit(last["turn"]).alias("turn"),
                F.lit(last["draw"]).alias("draw"),
                F.lit(last["doc_id"]).cast("bigint").alias("doc_id"),
                F.lit(last["size"]).cast("bigint").alias("size"),
            )
            cut = tuple(_entry(turn) <= at for turn in (0, 1))
    copies = F.when(F.col("size") > 0, sum(c.cast("bigint") for c in cut)).otherwise(0)
    return rows.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * copies).cast("bigint").alias("taken"),
        copies.cast("int").alias("copies"),
        "source",
        "draw",
    )


def _finish(turn: int) -> Column:
    return F.col("second") if turn else F.col("first")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, once per turn taken; columns as they were.

    In the order of a source, finish times only grow, so a turn takes all rows up to a last one. Two
    such last rows per source are joined to the texts, which are not exchanged unless the sources
    outgrow a broadcast.
    """
    own, of, once, twice, turn = free(docs, "_own", "_of", "_once", "_twice", "_turn")
    key = F.struct("draw", "doc_id", "size")
    lasts = mix(docs).groupBy(F.col("source").alias(of)).agg(
        F.max(F.when(F.col("copies") > 0, key)).alias(once),
        F.max(F.when(F.col("copies") > 1, key)).alias(twice),
    )
    lasts = written(lasts, "lasts")
    doc_id = docs["doc_id"].cast("bigint")
    keyed = docs.select(
        "*",
        F.struct(_draw(docs["doc_id"], SEED).alias("draw"), doc_id.alias("doc_id"), _size(docs).alias("size")).alias(own),
    )
    joined = keyed.join(lasts, docs["source"].cast("string").eqNullSafe(F.col(of)))
    times = [F.coalesce((F.col(own) <= F.col(c)).cast("int"), F.lit(0)) for c in (once, twice)]
    copies = F.when(F.col(own)["size"] > 0, times[0] + times[1]).otherwise(0)
    turns = F.explode(F.array_repeat(F.lit(1), copies)).alias(turn)
    return joined.select(*[docs[c] for c in docs.columns], turns).drop(turn)
