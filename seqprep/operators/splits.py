"""Train and validation splits by percentage of the row order."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from seqprep.operators.ranges import (
    Border,
    at_key,
    before_key,
    borders_at,
    from_key,
    key_ranges,
    with_position,
)
from seqprep.plans.storage import written

# The percentage rules in use. The second one drops the last 5 percent.
FRONT_VALIDATION = {"validation": (None, 5), "train": (5, None)}
TAIL_DROPPED = {"train": (None, 90), "validation": (90, 95)}

REQUIRED_SPLITS = ("train", "validation")

SplitRule = Mapping[str, tuple[float | None, float | None]]


def slice_bound(percent: float, rows: int) -> int:
    """Row position of a percentage: rounded to the nearest, halves to even."""
    return round(percent * rows / 100.0)


@dataclass(frozen=True)
class _Cut:
    """A bound of a rule: its position, and the key there (None past the last row)."""

    position: int
    keys: tuple[str, ...]
    key: Row | None
    # Rows of this key that lie before the position, where nothing tells them apart.
    skip: int = 0


def _cut(df: DataFrame, position: int, keys: tuple[str, ...], border: Border | None, ties: tuple[str, ...]) -> _Cut:
    if border is None or border.skip == 0 or not ties:
        return _Cut(position, keys, border and border.key, border.skip if border else 0)
    # Inside rows of one key the bound is a place in the order of the tie-break.
    same = df.filter(at_key(df, keys, border.key))
    inner = borders_at(same, key_ranges(same, ties), [border.skip])[0]
    return _Cut(position, keys + ties, Row(*border.key, *inner.key), inner.skip)


def _parts(
    df: DataFrame, rule: SplitRule, order_by: Sequence[str], tie_break: Sequence[str]
) -> list[tuple[DataFrame, dict[str, Column]]]:
    """Parts of the rows, and in each one predicate per split.

    There is one part, and its predicates compare the order key, unless a bound falls among rows that
    nothing tells apart; only those rows are then written down and numbered.
    """
    keys, ties = tuple(order_by), tuple(tie_break)
    ranges = key_ranges(df, keys)
    bounds = sorted({p for span in rule.values() for p in span if p is not None})
    positions = [slice_bound(p, ranges.total) for p in bounds]
    found = borders_at(df, ranges, positions)
    cuts = {
        p: _cut(df, position, keys, border, ties)
        for p, position, border in zip(bounds, positions, found, strict=True)
    }
    plain = {}
    for name, (low, high) in rule.items():
        inside = F.lit(True) if high is None else before_key(df, cuts[high].keys, cuts[high].key)
        if low is not None:
            inside = inside & from_key(df, cuts[low].keys, cuts[low].key)
        plain[name] = inside
    tied = {cut.key: cut for cut in cuts.values() if cut.skip}
    if not tied:
        return [(df, plain)]
    among = [at_key(df, cut.keys, key) for key, cut in tied.items()]
    parts = [(df.filter(~reduce(or_, among)), plain)]
    for same, cut in zip(among, tied.values(), strict=True):
        rows = _numbered(df.filter(same), cut.position - cut.skip)
        inside = {}
        for name, (low, high) in rule.items():
            at = F.col(_POSITION)
            inside[name] = (F.lit(True) if high is None else at < cuts[high].position) & (
                F.lit(True) if low is None else at >= cuts[low].position
            )
        parts.append((rows, inside))
    return parts


_POSITION, _CONTENT, _PLACE = "_position", "_content", "_place"


def _numbered(rows: DataFrame, first: int) -> DataFrame:
    """Rows of one key with their positions, by content; equal rows stand in for each other.

    They are written down with a number, so that every pass sees the same order.
    """
    plain = [f.name for f in rows.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    marked = rows.withColumns(
        {_CONTENT: F.xxhash64(*[F.col(f"`{c}`") for c in plain]), _PLACE: F.monotonically_increasing_id()}
    )
    kept = written(marked, "ties")
    placed = with_position(kept, key_ranges(kept, [_CONTENT, _PLACE]), _POSITION)
    return placed.withColumn(_POSITION, F.col(_POSITION) + first).drop(_CONTENT, _PLACE)


def with_split(
    df: DataFrame, rule: SplitRule, order_by: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """Add a ``split`` column by position in the order of ``order_by``; rows in no split go.

    The rows are compared with the border keys and are neither sorted nor exchanged. ``order_by`` need
    not be unique: a bound among rows of one key cuts them in the order of ``tie_break``, columns
    that tell them apart, or else of their content, so that every split has its exact number of rows.
    """

    def labelled(rows: DataFrame, conditions: dict[str, Column]) -> DataFrame:
        label = F.lit(None).cast("string")
        for name, inside in conditions.items():
            label = F.when(inside, F.lit(name)).otherwise(label)
        chosen = rows.filter(reduce(or_, conditions.values())).withColumn("split", label)
        return chosen.drop(_POSITION)

    return _union([labelled(*part) for part in _parts(df, rule, order_by, tie_break)])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def split_by_rule(
    df: DataFrame, rule: SplitRule, order_by: Sequence[str], tie_break: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """One DataFrame per split, each a filter on the order key that reaches the scan."""
    parts = _parts(df, rule, order_by, tie_break)
    return {
        name: _union([rows.filter(inside[name]).drop(_POSITION) for rows, inside in parts]) for name in rule
    }


def pct_slice(
    df: DataFrame,
    order_by: Sequence[str],
    low: float | None = None,
    high: float | None = None,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Rows in ``[low%, high%)`` of the row order."""
    return split_by_rule(df, {"slice": (low, high)}, order_by, tie_break)["slice"]


def splits(df: DataFrame, required: Iterable[str] = REQUIRED_SPLITS) -> dict[str, DataFrame]:
    """One DataFrame per required split; raises if one of them has no rows."""
    found = {name: df.filter(F.col("split") == name).drop("split") for name in required}
    missing = [name for name, rows in found.items() if rows.isEmpty()]
    if missing:
        raise ValueError(f"the dataset has no {' and no '.join(missing)} split")
    return found
