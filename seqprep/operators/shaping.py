"""Shaping of whole tables: pairs, rendered conversations, output projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.functions.text import CHAT_MARKERS, Markers, render_message
from seqprep.operators.ranges import ROWS_PER_RANGE, key_ranges, neighbour, running_sum

# Turns rendered into one output row; a longer conversation continues in the next part.
PART_TURNS = 1_024

SEQUENCE_COLUMNS = ("input_ids", "attention_mask", "position_ids")


def map_roles(df: DataFrame, instruction_col: str, response_col: str) -> DataFrame:
    """Give the dataset's own instruction and response columns their common names."""
    renamed = {instruction_col: "instruction", response_col: "response"}
    taken = set(renamed.values()) - set(renamed)
    rest = [F.col(c) for c in df.columns if c not in renamed and c not in taken]
    return df.select(*rest, *[F.col(old).alias(new) for old, new in renamed.items()])


def instruction_pairs(
    conversations: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``(key, turn, instruction, response)``: each user turn answered by the very next turn.

    The turn after a row is looked up inside a range of (key, turn), so one conversation may be of
    any length.
    """
    turns = conversations.select(key, turn, "role", "text")
    ranges = key_ranges(turns, [key, turn], rows_per_range)
    following = neighbour(turns, [key], [turn], ["role", "text"], ranges, step=1, name="_next")
    answered = (F.col("role") == "user") & (F.col("_next.role") == "assistant")
    return following.filter(answered).select(
        key, turn, F.col("text").alias("instruction"), F.col("_next.text").alias("response")
    )


def ordered_parts(
    conversations: DataFrame,
    key: str,
    turn: str,
    piece: Column,
    part_turns: int,
) -> DataFrame:
    """Turns of a conversation in order, at most ``part_turns`` to a row; ``parts`` is their number.

    Parts go by a turn's rank in its conversation, whatever its number. The rank is counted in value
    ranges, so one conversation may be of any length.
    """
    turns = conversations.select(key, F.col(turn).alias("_turn"), piece.alias("_piece"))
    ranges = key_ranges(turns, [key, "_turn"])
    ranked = running_sum(turns, [key], ["_turn"], F.lit(1), ranges, "_at", total="_of")
    part = F.floor((F.col("_at") - 1) / F.lit(part_turns)).cast("bigint")
    item = F.when(F.col("_piece").isNotNull(), F.struct("_turn", "_piece"))
    return ranked.groupBy(key, part.alias("part")).agg(
        F.sort_array(F.collect_list(item)).alias("_items"),
        F.bool_or(F.col("_at") == 1).alias("_first"),
        F.bool_or(F.col("_at") == F.col("_of")).alias("_last"),
        F.max(F.ceil(F.col("_of") / F.lit(part_turns))).cast("bigint").alias("parts"),
    )


def render_conversations(
    conversations: DataFrame,
    markers: Markers = CHAT_MARKERS,
    generation_marker: str | None = None,
    key: str = "conv_id",
    turn: str = "turn",
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """``(key, part, text)``: the rendered turns of each conversation, in order.

    A conversation of up to ``part_turns`` turns is one row. A longer one has further parts; its
    text is the concatenation of its parts, and the generation marker ends the last one.
    """
    piece = render_message(F.col("role"), F.col("text"), markers)
    parts = ordered_parts(conversations, key, turn, piece, part_turns)
    text = F.array_join(F.col("_items._piece"), "")
    if generation_marker is not None:
        text = F.concat(text, F.when(F.col("_last"), generation_marker).otherwise(""))
    return parts.select(key, "part", text.alias("text"))


def keep_present(df: DataFrame, column: str) -> DataFrame:
    """Rows in which ``column`` has a value."""
    return df.filter(F.col(column).isNotNull())


def project_sequence(df: DataFrame, columns: Sequence[str] = SEQUENCE_COLUMNS) -> DataFrame:
    """Keep the named sequence columns only; by default the labels are not among them."""
    return df.select(*columns)


def cast_arrays(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns as arrays of 64-bit integers."""
    return df.withColumns({c: F.col(c).cast("array<bigint>") for c in columns})


def require_columns(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Check, before anything runs, that ``df`` has the named columns with the given types."""
    found = dict(df.dtypes)
    wrong = {c: found.get(c, "missing") for c, t in schema.items() if found.get(c) != t}
    if wrong:
        raise TypeError(f"expected {dict(schema)}, found {wrong}")
    return df
