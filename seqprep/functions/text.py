"""Row text: prompts, message lists, chat rendering and routing, all as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text of a missing value, prompt headings, and the markers of the one chat
# template in use (role -> text put before the content; no text after it; generation marker).
MISSING_TEXT = "None"
INSTRUCTION_HEADING = "##INSTRUCTION "
RESPONSE_HEADING = "\n\n##RESPONSE "
CHAT_MARKERS = {
    "system": ("", ""),
    "user": ("<reserved_102>", ""),
    "assistant": ("<reserved_103>", ""),
}
GENERATION_MARKER = "<reserved_107>"

# Architecture names looked for in a lower-cased name, first match wins; a rule may
# exclude a longer name. The second list finds the layers to adapt, the third the architectures whose
# fixed parameters are cast.
ARCHITECTURE_RULES = [
    ("baichuan", None, "baichuan"),
    ("gemma2", None, "gemma2"),
    ("internlm", None, "internlm"),
    ("qwen", "qwen2", "qwen"),
    ("chatglm", None, "chatglm"),
]
ADAPTED_LAYER_RULES = [("baichuan", None, "W_pack"), ("qwen", None, "c_proj")]
DEFAULT_ADAPTED_LAYERS = "q_proj,v_proj"
CAST_RULES = [("llama", None, "cast"), ("qwen2", None, "cast"), ("gemma", None, "cast")]

Markers = Mapping[str, tuple[str, str]]


def text_of(value: Column) -> Column:
    """Text of a value, where a missing one reads ``None``."""
    return F.coalesce(value.cast("string"), F.lit(MISSING_TEXT))


def plain_prompt(instruction: Column, response: Column) -> Column:
    """Instruction and response under headings, for models without a chat template."""
    return F.concat(
        F.lit(INSTRUCTION_HEADING),
        text_of(instruction),
        F.lit(RESPONSE_HEADING),
        text_of(response),
    )


def message(role: str | Column, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def pair_messages(instruction: Column, response: Column) -> Column:
    """The message list of a pair: one user message, one assistant message."""
    return F.array(
        message("user", text_of(instruction)), message("assistant", text_of(response))
    )


def render_message(role: Column, content: Column, markers: Markers = CHAT_MARKERS) -> Column:
    """Prefix, content and suffix of one message; a role without markers adds nothing."""
    rendered = F.lit("")
    for known, (prefix, suffix) in markers.items():
        body = F.concat(F.lit(prefix), text_of(content), F.lit(suffix))
        rendered = F.when(role == known, body).otherwise(rendered)
    return rendered


def render_chat(
    messages: Column,
    markers: Markers = CHAT_MARKERS,
    generation_marker: str | None = None,
) -> Column:
    """Text of a message list in its order, with the generation marker at the end if given."""
    pieces = F.transform(messages, lambda m: render_message(m["role"], m["content"], markers))
    text = F.array_join(pieces, "")
    return text if generation_marker is None else F.concat(text, F.lit(generation_marker))


def append_eos(text: Column, eos: str) -> Column:
    return F.concat(text, F.lit(eos))


def route(
    name: Column, rules: Sequence[tuple[str, str | None, str]], default: str | None
) -> Column:
    """Label of the first rule whose needle occurs in the lower-cased name.

    A rule is ``(needle, excluded, label)``; it does not match a name that holds ``excluded``.
    """
    lowered = F.lower(name)
    chosen = F.lit(default)
    for needle, excluded, label in reversed(rules):
        hit = lowered.contains(needle)
        if excluded is not None:
            hit = hit & ~lowered.contains(excluded)
        chosen = F.when(hit, F.lit(label)).otherwise(chosen)
    return chosen


def route_exact(name: Column, labels: Mapping[str, str], default: str | None) -> Column:
    """Label of the rule whose name is exactly the given one."""
    chosen = F.lit(default)
    for known, label in labels.items():
        chosen = F.when(name == known, F.lit(label)).otherwise(chosen)
    return chosen


def last_part(text: Column, separator: str) -> Column:
    """What follows the last ``separator``."""
    return F.substring_index(text, separator, -1)
