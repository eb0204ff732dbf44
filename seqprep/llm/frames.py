"""What the operators share on the side of Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.plans.storage import written

#: A word of the contracts: anything between white space of ASCII.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_SIGNS = " \t\n\x0b\x0c\r"

#: Bits of a set of keys that is broadcast; its size does not depend on the data.
BITS = 1 << 23

__all__ = ["SPACE_SIGNS", "WORD", "bit_set", "free", "id_remainder", "likely", "passing", "text_bytes", "without", "written"]


def text_bytes(docs: DataFrame, *columns: str, text: str = "text") -> DataFrame:
    """``doc_id`` as long, the wanted columns, and the text's UTF-8 bytes as ``_data``."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *columns,
        F.col(text).cast("string").cast("binary").alias("_data"),
    )


def id_remainder(divisor: int) -> Column:
    """``crc32(doc_id as text) mod divisor``; NULL without an id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def free(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores behind it until no column of ``docs`` is called so."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
        taken.add(name.lower())
    return out


def without(docs: DataFrame, keys: DataFrame, how: str = "left_anti") -> DataFrame:
    """Rows of ``docs`` whose key is not in ``keys`` (``doc_id``, ``_text``); columns as they were."""
    gone_id, gone_text = free(docs, "_gone_id", "_gone_text")
    named = keys.select(F.col("doc_id").alias(gone_id), F.col("_text").alias(gone_text))
    doc_id, text = docs["doc_id"].cast("bigint"), F.xxhash64(docs["text"].cast("string"))
    same = doc_id.eqNullSafe(F.col(gone_id)) & text.eqNullSafe(F.col(gone_text))
    return docs.join(named, same, how)


def bit_set(keys: DataFrame, name: str) -> bytes:
    """One of ``BITS`` bits per key, by its low bits; gathered as ``BITS / 32768`` rows of 4 KB.

    It only saves shuffling: whatever passes it is joined with the keys.
    """
    # Spark numbers the bits of its bit sets from 1.
    place = F.col(name).bitwiseAND(F.lit(BITS - 1)) + 1
    rows = (
        keys.select(place.alias("p"))
        .groupBy(F.expr("bitmap_bucket_number(p)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits"))
        .collect()
    )
    out = bytearray(BITS // 8)
    for row in rows:
        start = (row["bucket"] - 1) * 4096
        out[start : start + 4096] = row["bits"]
    return bytes(out)


def passing(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which 64-bit ``keys`` may be in the set that ``bits`` (bytes) was made from."""
    place = keys & np.uint64(BITS - 1)
    bit = np.uint8(1) << (place & np.uint64(7)).astype(np.uint8)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] & bit) > 0


def likely(rows: DataFrame, name: str, bits: bytes) -> DataFrame:
    """Rows whose long column ``name`` may be in the set, and a few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bits, np.uint8)
        for batch in batches:
            keys = batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            yield batch.filter(pa.array(passing(known, keys)))

    return rows.mapInArrow(run, rows.schema)
