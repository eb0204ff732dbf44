"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.plans.storage import written


def components(links: DataFrame) -> DataFrame:
    """``(u, v)``: each linked node that is not the smallest of its component, and the smallest.

    ``links`` has two columns ``u`` and ``v`` of one ordered type; direction, repeats and loops do
    not matter, and no links give no rows. Each round hangs the larger neighbours of a node on its
    smallest one, then the smaller ones; a node with very many neighbours costs one partial minimum
    per task and a join that Spark splits. The driver sees two numbers a round.
    """
    low, high = F.least("u", "v"), F.greatest("u", "v")
    edges = links.filter("u <> v").select(high.alias("u"), low.alias("v")).distinct()
    edges, before = written(edges, "links"), None
    while True:
        state = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == before:
            return edges
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_v")).select("u", F.least("u", "_v").alias("_m"))
        large = both.filter("v > u").join(least, "u")
        large = large.select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("_m"))
        moved = large.join(small, "u").filter("v <> _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))
        edges = written(moved.unionByName(small.select("u", F.col("_m").alias("v"))).distinct(), "links")
