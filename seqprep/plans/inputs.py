"""The given tables in the shapes that the operators read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.operators.ranges import NARROW_ROWS_PER_RANGE, key_ranges, running_sum
from seqprep.operators.shaping import instruction_pairs
from seqprep.plans.run_parameters import RUN_PARAMETERS, run_parameters
from seqprep.plans.storage import read_spread

# Texts up to which a response ends by itself in the rendered responses.
STOP_TOKENS = 100


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for work on their text, on every core."""
    return read_spread(spark, table_path(sf_dir, "documents"), "doc_id")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instruction_pairs(table(spark, sf_dir, "conversations"))


def run_events(
    spark: SparkSession, sf_dir: str, rows_per_range: int = NARROW_ROWS_PER_RANGE
) -> DataFrame:
    """The event table as training events: a user is a run, a value is a loss.

    In the order of time, a run's first event is its begin, the last its evaluation, the one before
    the end of its epoch; other signups are logs without a loss, and the rest are steps.
    """
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_type",
        "value",
    )
    order = ["ts", "seq"]
    ranges = key_ranges(events, ["run_id", *order], rows_per_range)
    placed = running_sum(events, ["run_id"], order, F.lit(1), ranges, "_at", total="_of")
    kind = (
        F.when(F.col("_at") == 1, "begin")
        .when(F.col("_at") == F.col("_of"), "evaluate")
        .when(F.col("_at") == F.col("_of") - 1, "epoch_end")
        .when(F.col("event_type") == "signup", "eval_log")
        .otherwise("step")
    )
    is_step = (F.col("kind") == "step").cast("bigint")
    stepped = running_sum(
        placed.withColumn("kind", kind), ["run_id"], order, is_step, ranges, "step"
    )
    shaped = stepped.select(
        "run_id",
        "seq",
        "step",
        "kind",
        "ts",
        F.when(F.col("kind") == "step", F.col("value")).alias("loss"),
    )
    preset = F.col("run_id") % len(RUN_PARAMETERS)
    parameters = run_parameters(spark).select(
        "preset", "train_batch", F.col("lr").alias("learning_rate")
    )
    return shaped.withColumn("preset", preset).join(F.broadcast(parameters), "preset").drop("preset")


def response_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each answered turn as a chat response record in JSON; tokens are words here."""
    words = lambda c: F.size(F.split(F.trim(c), r"\s+")).cast("bigint")
    counted = pairs(spark, sf_dir).withColumns(
        {"_p": words("instruction"), "_c": words("response")}
    )
    none = F.lit(None).cast("string")
    said = F.struct(
        F.lit("assistant").alias("role"),
        none.alias("reasoning_content"),
        F.col("response").alias("content"),
        F.array().cast("array<string>").alias("tool_calls"),
    )
    choice = F.struct(
        F.lit(0).alias("index"),
        said.alias("message"),
        none.alias("logprobs"),
        F.when(F.col("_c") <= STOP_TOKENS, "stop").otherwise("length").alias("finish_reason"),
        none.alias("stop_reason"),
    )
    usage = F.struct(
        F.col("_p").alias("prompt_tokens"),
        (F.col("_p") + F.col("_c")).alias("total_tokens"),
        F.col("_c").alias("completion_tokens"),
        none.alias("prompt_tokens_details"),
    )
    record = F.struct(
        F.concat_ws("-", F.lit("chatcmpl"), "conv_id", "turn").alias("id"),
        F.lit("chat.completion").alias("object"),
        F.col("turn").alias("created"),
        F.concat(F.lit("model-"), (F.col("conv_id") % 3).cast("string")).alias("model"),
        F.array(choice).alias("choices"),
        usage.alias("usage"),
        none.alias("prompt_logprobs"),
    )
    body = F.to_json(record, {"ignoreNullFields": "false"})
    return counted.select("conv_id", "turn", body.alias("body"))
