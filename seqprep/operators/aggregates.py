"""Flagged shares and token-usage totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.functions.scalars import percentage


def flagged_share(
    df: DataFrame, value: Column, flag: Column, by: Sequence[str] = ()
) -> DataFrame:
    """Sum where the flag holds, sum of all, and the first as a percentage of the second."""
    sums = df.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(flag, value)), F.sum(value) * 0).alias("flagged"),
        F.sum(value).alias("total"),
    )
    return sums.withColumn("percent", percentage(F.col("flagged"), F.col("total")))


def usage_rollup(responses: DataFrame, by: Sequence[str] = ("model", "finish_reason")) -> DataFrame:
    """Token sums and record counts; ``consistent`` counts records where the total adds up.

    Expects one row per response, that is the rows of choice 0 (or none).
    """
    adds_up = F.col("total_tokens") == F.col("prompt_tokens") + F.col("completion_tokens")
    first_choice = F.coalesce(F.col("choice"), F.lit(0)) == 0
    return (
        responses.filter(first_choice)
        .groupBy(*by)
        .agg(
            F.count("*").alias("responses"),
            F.sum("prompt_tokens").alias("prompt_tokens"),
            F.sum("completion_tokens").alias("completion_tokens"),
            F.sum("total_tokens").alias("total_tokens"),
            F.count_if(adds_up).alias("consistent"),
        )
    )
