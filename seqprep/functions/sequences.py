"""Fixed-length token sequences as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: label of a position that does not count towards the loss.
IGNORE_LABEL = -100

LONGS = "array<bigint>"


def _constant(value: int | None) -> Column:
    return F.lit(value).cast("bigint")


def pad_id_or_eos(pad_id: int | None, eos_id: int | None) -> Column:
    """Pad id, or the end id where there is no pad id."""
    return F.coalesce(_constant(pad_id), _constant(eos_id))


def truncate(ids: Column, length: int) -> Column:
    """The first ``length`` ids."""
    return F.slice(ids, 1, length)


def _fill(value: Column, count: Column) -> Column:
    return F.array_repeat(value, F.greatest(count, F.lit(0)))


def pad(ids: Column, length: int, pad_id: Column | int, side: str = "right") -> Column:
    """Exactly ``length`` ids: filled up with ``pad_id`` on one side, never cut here."""
    value = _constant(pad_id) if isinstance(pad_id, int) else pad_id
    filler = _fill(value, F.lit(length) - F.size(ids))
    parts = {"right": (ids, filler), "left": (filler, ids)}[side]
    return F.concat(*parts).cast(LONGS)


def length_mask(count: Column, length: int, side: str = "right") -> Column:
    """1 for each of ``count`` real ids, 0 for padding, by position alone."""
    real = F.least(count, F.lit(length))
    ones = _fill(_constant(1), real)
    zeros = _fill(_constant(0), F.lit(length) - real)
    return F.concat(*((ones, zeros) if side == "right" else (zeros, ones)))


def value_mask(ids: Column, pad_id: int | None, eos_id: int | None = None) -> Column:
    """1 where an id is not the pad id.

    Where the pad id is the end id, real end marks inside the text are masked as well.
    """
    value = pad_id_or_eos(pad_id, eos_id)
    return F.transform(ids, lambda x: (x != value).cast("bigint"))


def mask_labels(ids: Column, mask: Column, ignore: int = IGNORE_LABEL) -> Column:
    """Ids as labels, with every masked-out position replaced by ``ignore``."""
    return F.zip_with(ids, mask, lambda x, m: F.when(m != 0, x).otherwise(_constant(ignore)))


def copy_labels(ids: Column) -> Column:
    """Ids as labels unchanged: padding is *not* ignored."""
    return ids


def position_ids(length: int) -> Column:
    """0 .. length-1, the same constant for every row."""
    if length <= 0:
        return F.array().cast(LONGS)
    return F.sequence(_constant(0), _constant(length - 1))
