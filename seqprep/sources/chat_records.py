"""Chat request and chat response records as JSON text."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.functions.text import message
from seqprep.operators.shaping import PART_TURNS, ordered_parts

# Fixed value: the schema of a chat response record.
RESPONSE_SCHEMA = """
  id string, object string, created bigint, model string,
  choices array<struct<
    index int,
    message: struct<
      role string, reasoning_content string, content string, tool_calls array<string>>,
    logprobs string, finish_reason string, stop_reason string>>,
  usage struct<
    prompt_tokens bigint, total_tokens bigint, completion_tokens bigint,
    prompt_tokens_details string>,
  prompt_logprobs string
"""


def to_chat_requests(
    conversations: DataFrame,
    model: str,
    max_tokens: int,
    key: str = "conv_id",
    turn: str = "turn",
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """``(key, part, parts, body)``: the JSON chat request that holds a conversation's messages.

    The body of a conversation of up to ``part_turns`` turns is one complete record; a longer one
    is the concatenation of its parts.
    """
    piece = F.to_json(message(F.col("role"), F.col("text")), {"ignoreNullFields": "false"})
    parts = ordered_parts(conversations, key, turn, piece, part_turns)
    head = f'{{"model":{json.dumps(model, ensure_ascii=False)},"messages":['
    tail = f'],"max_tokens":{int(max_tokens)}}}'
    body = F.concat(
        F.when(F.col("_first"), head).otherwise(","),
        F.array_join(F.col("_items._piece"), ","),
        F.when(F.col("_last"), tail).otherwise(""),
    )
    return parts.select(key, "part", "parts", body.alias("body"))


def write_chat_requests(requests: DataFrame, path: str) -> None:
    """One request per line under ``path``; requests of several parts under ``path`` + ``_parts``.

    There each part is a JSON line of the key, ``part``, ``parts`` and ``body``; a request is the
    concatenation of its bodies by ``part``. A line of ``path`` is always a whole record.
    """
    requests.filter("parts = 1").select("body").write.mode("overwrite").text(path)
    rest = requests.filter("parts > 1").write.mode("overwrite").option("ignoreNullFields", "false")
    rest.json(f"{path.rstrip('/')}_parts")


def read_chat_responses(df: DataFrame, json_col: str) -> DataFrame:
    """Response records as typed rows, one per choice; a record without choices keeps one row.

    Other columns of ``df`` stay. Text that is not a record gives NULL in every response column.
    """
    parsed = df.withColumn("_r", F.from_json(json_col, RESPONSE_SCHEMA)).drop(json_col)
    choice = parsed.withColumn("_c", F.explode_outer("_r.choices"))
    return choice.select(
        *[c for c in df.columns if c != json_col],
        "_r.id", "_r.object", "_r.created", "_r.model",
        F.col("_c.index").alias("choice"),
        "_c.message.role", "_c.message.reasoning_content", "_c.message.content",
        "_c.message.tool_calls", "_c.logprobs", "_c.finish_reason", "_c.stop_reason",
        "_r.usage.prompt_tokens", "_r.usage.completion_tokens", "_r.usage.total_tokens",
        "_r.usage.prompt_tokens_details", "_r.prompt_logprobs",
    )


def read_any_responses(df: DataFrame, json_col: str) -> tuple[DataFrame, DataFrame]:
    """Response records of any shape as rows per choice, and the rows whose text is not JSON.

    The columns are those of :func:`read_chat_responses`, but ``tool_calls``, ``logprobs``,
    ``usage`` and the whole ``record`` are VARIANT values, so that structured calls and fields that no
    schema names are kept; a field of another type than its column is NULL there and still in the record.
    A record without a list of choices keeps one row, NULL text is a row without a record.
    """
    other = [c for c in df.columns if c != json_col]
    text = F.col(json_col)
    parsed = df.withColumn("record", F.try_parse_json(text))
    broken = parsed.filter(text.isNotNull() & F.col("record").isNull()).select(*df.columns)
    kept = parsed.filter(text.isNull() | F.col("record").isNotNull())
    choices = F.try_variant_get("record", "$.choices", "array<variant>")
    rows = kept.select(*other, "record", F.explode_outer(choices).alias("_c"))

    def of(part: str, path: str, kind: str, name: str | None = None) -> Column:
        return F.try_variant_get(part, f"$.{path}", kind).alias(name or path.rpartition(".")[2])

    return rows.select(
        *other,
        of("record", "id", "string"),
        of("record", "object", "string"),
        of("record", "created", "bigint"),
        of("record", "model", "string"),
        of("_c", "index", "int", "choice"),
        of("_c", "message.role", "string"),
        of("_c", "message.reasoning_content", "string"),
        of("_c", "message.content", "string"),
        of("_c", "message.tool_calls", "variant"),
        of("_c", "logprobs", "variant"),
        of("_c", "finish_reason", "string"),
        of("_c", "stop_reason", "string"),
        of("record", "usage.prompt_tokens", "bigint"),
        of("record", "usage.completion_tokens", "bigint"),
        of("record", "usage.total_tokens", "bigint"),
        of("record", "usage", "variant"),
        "record",
    ), broken
