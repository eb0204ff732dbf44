"""From instruction pairs to fixed-length training sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.functions.sequences import copy_labels, length_mask, pad, position_ids
from seqprep.functions.text import (
    CHAT_MARKERS,
    Markers,
    append_eos,
    pair_messages,
    plain_prompt,
    render_chat,
)
from seqprep.operators.vocab import EOS, PAD, SPECIALS, build_vocab, encode
from seqprep.sources.datasets import DatasetSpec, dataset_spec, read_dataset


def training_text(
    instruction: Column,
    response: Column,
    markers: Markers | None = CHAT_MARKERS,
    eos: str | None = None,
) -> Column:
    """Chat text of a pair, or the plain prompt without markers; the end mark where given."""
    if markers is None:
        text = plain_prompt(instruction, response)
    else:
        text = render_chat(pair_messages(instruction, response), markers)
    return text if eos is None else append_eos(text, eos)


def text_marks(markers: Markers | None = CHAT_MARKERS, eos: str | None = EOS) -> tuple[str, ...]:
    """Markers and end mark: what counts as one token wherever it occurs."""
    affixes = [affix for pair in (markers or {}).values() for affix in pair if affix]
    return (*affixes, eos) if eos else tuple(affixes)


def add_sequences(df: DataFrame, ids: str, block: int, pad_id: int, side: str = "right") -> DataFrame:
    """Add input ids, attention mask, labels and positions, each ``block`` long."""
    padded = pad(F.col(ids), block, pad_id, side)
    return df.withColumns(
        {
            "input_ids": padded,
            "attention_mask": length_mask(F.size(ids), block, side),
            "labels": copy_labels(padded),
            "position_ids": position_ids(block),
        }
    ).drop(ids)


def prepare_sequences(
    pairs: DataFrame,
    key: Sequence[str],
    vocab: DataFrame,
    block: int,
    text: str = "text",
    marks: Sequence[str] = (),
    keep_labels: bool = True,
) -> DataFrame:
    """Rows with a text column as training sequences; the text itself is not kept."""
    encoded = encode(pairs, key, text, vocab, block, marks=marks, name="_ids").drop(text)
    out = add_sequences(encoded, "_ids", block, SPECIALS.index(PAD))
    return out if keep_labels else out.drop("labels")


def prepare_dataset(
    spark: SparkSession,
    name: str,
    path: str | Sequence[str],
    key: Sequence[str],
    block: int,
    vocab_size: int,
    markers: Markers | None = CHAT_MARKERS,
    registry: dict[str, DatasetSpec] | None = None,
) -> DataFrame:
    """A named dataset as training sequences: ``key``, ``split`` and the arrays.

    Split rule, columns, end mark and labels follow the dataset's entry. The vocabulary is that of
    all rows in a split; the rows are read once for it and once for the sequences, and exchanged in
    neither.
    """
    spec = dataset_spec(name, registry)
    rows = read_dataset(spark, name, path, registry)
    eos = EOS if spec.append_eos else None
    text = training_text(F.col("instruction"), F.col("response"), markers, eos)
    texts = rows.select(*key, "split", text.alias("text"))
    marks = text_marks(markers, eos)
    specials = (*SPECIALS, *[mark for mark in marks if mark not in SPECIALS])
    vocab = build_vocab(texts, "text", vocab_size, specials, marks)
    return prepare_sequences(texts, key, vocab, block, "text", marks, spec.keep_labels)
