"""Values worked out by hand."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seqprep.functions import scalars, sequences, text
from seqprep.plans.prepare import training_text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0]["v"]


def ids(*numbers):
    return F.lit(list(numbers)).cast("array<bigint>") if numbers else F.array().cast("array<bigint>")


def chat(*messages):
    return F.array(*[text.message(role, F.lit(content)) for role, content in messages])


def test_plain_prompt(spark):
    assert value(spark, text.plain_prompt(F.lit("a"), F.lit("b"))) == "##INSTRUCTION a\n\n##RESPONSE b"


def test_plain_prompt_of_missing_text(spark):
    missing = F.lit(None).cast("string")
    assert value(spark, text.plain_prompt(F.lit("a"), missing)) == "##INSTRUCTION a\n\n##RESPONSE None"


def test_pair_with_missing_text(spark):
    pair = text.pair_messages(F.lit(None).cast("string"), F.lit("b"))
    assert [tuple(m) for m in value(spark, pair)] == [("user", "None"), ("assistant", "b")]


def test_chat_markers(spark):
    pair = text.pair_messages(F.lit("a"), F.lit("b"))
    assert value(spark, text.render_chat(pair)) == "<reserved_102>a<reserved_103>b"


def test_chat_system_and_generation(spark):
    rendered = text.render_chat(
        chat(("system", "s"), ("user", "a")), generation_marker=text.GENERATION_MARKER
    )
    assert value(spark, rendered) == "s<reserved_102>a<reserved_107>"


def test_chat_unknown_role_adds_nothing(spark):
    assert value(spark, text.render_chat(chat(("tool", "t"), ("user", "a")))) == "<reserved_102>a"


def test_chat_own_markers_and_eos(spark):
    markers = {"user": ("[U]", "[/U]"), "assistant": ("", "\n")}
    rendered = training_text(F.lit("a"), F.lit("b"), markers, eos="</s>")
    assert value(spark, rendered) == "[U]a[/U]b\n</s>"


def test_training_text_without_template(spark):
    rendered = training_text(F.lit("a"), F.lit("b"), markers=None)
    assert value(spark, rendered) == "##INSTRUCTION a\n\n##RESPONSE b"


@pytest.mark.parametrize(
    ("name", "label"),
    [
        ("BaichuanForCausalLM", "baichuan"),
        ("QWenLMHeadModel", "qwen"),
        ("Qwen2ForCausalLM", "auto"),
        ("Gemma2ForCausalLM", "gemma2"),
        ("LlamaForCausalLM", "auto"),
        ("baichuan-qwen", "baichuan"),
    ],
)
def test_route(spark, name, label):
    assert value(spark, text.route(F.lit(name), text.ARCHITECTURE_RULES, "auto")) == label


def test_route_exact(spark):
    column = text.route_exact(F.lit("b"), {"a": "1", "b": "2"}, "other")
    assert value(spark, column) == "2"
    assert value(spark, text.route_exact(F.lit("B"), {"b": "2"}, "other")) == "other"


def test_pad_right_and_left(spark):
    assert value(spark, sequences.pad(ids(5, 6), 4, 0)) == [5, 6, 0, 0]
    assert value(spark, sequences.pad(ids(5, 6), 4, 0, "left")) == [0, 0, 5, 6]
    assert value(spark, sequences.pad(ids(), 3, 0)) == [0, 0, 0]


def test_length_mask(spark):
    assert value(spark, sequences.length_mask(F.size(ids(5, 6)), 4)) == [1, 1, 0, 0]
    assert value(spark, sequences.length_mask(F.size(ids(5, 6)), 4, "left")) == [0, 0, 1, 1]
    assert value(spark, sequences.length_mask(F.lit(9), 3)) == [1, 1, 1]
    assert value(spark, sequences.length_mask(F.size(ids()), 3)) == [0, 0, 0]


def test_value_mask_hides_end_marks_when_they_pad(spark):
    assert value(spark, sequences.value_mask(ids(5, 2, 6, 2, 2), None, 2)) == [1, 0, 1, 0, 0]
    assert value(spark, sequences.value_mask(ids(5, 2, 0), 0, 2)) == [1, 1, 0]


def test_labels(spark):
    padded = ids(5, 6, 0, 0)
    assert value(spark, sequences.copy_labels(padded)) == [5, 6, 0, 0]
    masked = sequences.mask_labels(padded, sequences.value_mask(padded, 0))
    assert value(spark, masked) == [5, 6, -100, -100]


def test_truncate_and_positions(spark):
    assert value(spark, sequences.truncate(ids(1, 2, 3, 4, 5), 3)) == [1, 2, 3]
    assert value(spark, sequences.position_ids(4)) == [0, 1, 2, 3]
    assert value(spark, sequences.position_ids(0)) == []


def test_pad_id_falls_back_to_eos(spark):
    assert value(spark, sequences.pad_id_or_eos(None, 2)) == 2
    assert value(spark, sequences.pad_id_or_eos(0, 2)) == 0


def test_local_time(spark):
    noon = F.lit("2024-01-01 12:00:00")
    moment = noon.cast("timestamp")
    assert value(spark, scalars.local_time(moment, "Asia/Seoul")) == dt.datetime(2024, 1, 1, 21)
    naive = noon.cast("timestamp_ntz")
    assert value(spark, scalars.local_time(naive, "Asia/Seoul", "Asia/Tokyo")) == dt.datetime(2024, 1, 1, 12)


def test_scalars(spark):
    assert value(spark, scalars.element_count(ids(3, 4, 5))) == 60
    assert value(spark, scalars.element_count(ids())) == 1
    assert value(spark, scalars.whole_days(F.lit(190_000.5))) == 2
    assert value(spark, scalars.rest_of_day(F.lit(190_000.5))) == 17_200.5
    assert value(spark, scalars.as_interval(F.lit(86_461.5))) == dt.timedelta(days=1, seconds=61.5)
    assert value(spark, scalars.log_name_time(F.lit("240131_235959"))) == dt.datetime(
        2024, 1, 31, 23, 59, 59
    )
    assert value(spark, scalars.log_name_time(F.lit("nothing"))) is None
    assert value(spark, scalars.percentage(F.lit(10), F.lit(40))) == 25.0
    assert value(spark, text.last_part(F.lit("a/b/c"), "/")) == "c"
