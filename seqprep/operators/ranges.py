"""Work that depends on row order, spread over value ranges of the order key.

A global order, or the order inside one very large group, must not be computed in one task. The
order key is cut into contiguous ranges of similar size, by a sample and a partial count of the key
columns; no key is exchanged but one per range and task.
A range is a set of key *values*, so a row's range never depends on how a task was placed or
recomputed. Work inside a range is an ordinary window; what crosses a border is carried over by at
most one row per range.

Order keys should be unique: rows of one key have no order among themselves, though none of them is ever
lost (``splits`` says how a bound inside them cuts). Rows whose group is NULL are one group, however
many ranges there are.
"""

from __future__ import annotations

import datetime as dt
import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a range: whole rows, and rows of a few numbers.
ROWS_PER_RANGE = 50_000
NARROW_ROWS_PER_RANGE = 1_000_000
MAX_RANGES = 16_384
# Sampled keys of a range.
SAMPLES = 50
# Ranges up to which a row's range is found by generated code; its length grows with them.
TREE_RANGES = 64
LAST_STEP_ROWS = 100_000


@dataclass(frozen=True)
class KeyRanges:
    """Borders of contiguous key ranges, in order, with their row counts."""

    keys: tuple[str, ...]
    key_type: T.StructType
    total: int
    first: list[Row] = field(default_factory=list)
    last: list[Row] = field(default_factory=list)
    counts: list[int] = field(default_factory=list)

    @property
    def size(self) -> int:
        return max(1, len(self.first))

    @property
    def offsets(self) -> list[int]:
        """Number of rows before each range."""
        before, out = 0, []
        for count in self.counts:
            out.append(before)
            before += count
        return out or [0]


def _order_value(df: DataFrame, name: str) -> Column:
    """The key column in a form that compares alike in Spark and as a literal."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType)):
        return F.col(name).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(kind, T.TimestampNTZType):
        # From its own fields: a cast to a timestamp would depend on the session's time zone.
        seconds = F.hour(name) * 3_600 + F.minute(name) * 60
        second = F.expr(f"extract(SECOND FROM {_quoted(name)})")
        day = F.unix_date(F.col(name).cast("date")).cast("bigint")
        return (day * 86_400 + seconds) * 1_000_000 + (second * 1_000_000).cast("bigint")
    if isinstance(kind, T.FloatType):
        return F.col(name).cast("double")
    if isinstance(kind, T.BinaryType):
        return F.hex(name)
    if isinstance(kind, (T.CharType, T.VarcharType)):
        return F.col(name).cast("string")
    if isinstance(kind, (T.LongType, T.StringType, T.DoubleType, T.DecimalType)):
        return F.col(name)
    raise TypeError(f"cannot order by column {name!r} of type {kind.simpleString()}")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _value(kind: T.DataType, value: object) -> Column:
    """A key's order value, as a constant of the column's own type: a comparison reaches the scan."""
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    if isinstance(kind, T.TimestampNTZType):
        at = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=value)
        return F.lit(at.isoformat(sep=" ")).cast(kind)
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.lit(value).cast("int"))
    if isinstance(kind, T.BinaryType):
        return F.unhex(F.lit(value))
    return F.lit(value).cast("string" if isinstance(kind, (T.CharType, T.VarcharType)) else kind)


def order_struct(df: DataFrame, keys: Sequence[str]) -> Column:
    """The whole order key as one comparable value."""
    return F.struct(*[_order_value(df, k).alias(f"k{i}") for i, k in enumerate(keys)])


def _key_array(rows: Sequence[Row], key_type: T.StructType) -> Column:
    """Borders as one constant array; Catalyst folds it into a literal."""
    text = json.dumps([row.asDict() for row in rows], ensure_ascii=False, default=str)
    return F.from_json(F.lit(text), T.ArrayType(key_type))


def _scan(df: DataFrame, ranges: KeyRanges, pieces: int) -> list[Row]:
    """First key, last key and row count of about ``pieces`` contiguous ranges, in order.

    Borders come from a sample of the keys, chosen by their hash. Every row finds its range where it
    lies, and only one row per range and task is exchanged.
    """
    narrow = df.select(order_struct(df, ranges.keys).alias("key"))
    one_in = max(1, ranges.total // (pieces * SAMPLES))
    chosen = narrow.filter(F.pmod(F.xxhash64("key"), F.lit(one_in)) == 0)
    sample = [row["key"] for row in chosen.orderBy("key").collect()]
    borders = replace(ranges, first=sample[::SAMPLES])
    placed = df.select(order_struct(df, ranges.keys).alias("key"), range_id(df, borders).alias("piece"))
    found = (
        placed.groupBy("piece")
        .agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count("*").alias("n"))
        .collect()
    )
    return sorted(found, key=lambda row: row["piece"])


def key_ranges(
    df: DataFrame,
    keys: Sequence[str],
    rows_per_range: int = ROWS_PER_RANGE,
    max_ranges: int = MAX_RANGES,
) -> KeyRanges:
    """Cut the order key of ``df`` into ranges of about ``rows_per_range`` rows.

    The driver receives one row per range, never more than ``max_ranges``. A table that fits one
    range costs only a count.
    """
    keys = tuple(keys)
    key_type = df.select(order_struct(df, keys).alias("key")).schema["key"].dataType
    total = df.count()
    pieces = min(max_ranges, math.ceil(total / rows_per_range))
    if pieces <= 1:
        return KeyRanges(keys, key_type, total, counts=[total])
    rows = _scan(df, KeyRanges(keys, key_type, total), pieces)
    return KeyRanges(
        keys,
        key_type,
        total,
        [r["first"] for r in rows],
        [r["last"] for r in rows],
        [r["n"] for r in rows],
    )


def range_id(df: DataFrame, ranges: KeyRanges) -> Column:
    """Number of the range that holds a row: a binary search over the constant borders.

    Few borders are compared in a tree of conditions, for which Spark generates code; many, in a fold.
    """
    if ranges.size == 1:
        return F.lit(0)
    key = order_struct(df, ranges.keys)
    borders = _key_array(ranges.first, ranges.key_type)
    top = ranges.size - 1
    if ranges.size <= TREE_RANGES:

        def search(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            middle = (low + high + 1) // 2
            return F.when(F.get(borders, F.lit(middle)) <= key, search(middle, high)).otherwise(search(low, middle - 1))

        return search(0, top)
    strides = [2**i for i in reversed(range(top.bit_length()))]
    return F.aggregate(
        F.lit(strides),
        F.lit(0),
        lambda at, stride: F.when(
            (at + stride <= top) & (F.get(borders, at + stride) <= key), at + stride
        ).otherwise(at),
    )


def with_position(df: DataFrame, ranges: KeyRanges, name: str = "pos") -> DataFrame:
    """Add the 0-based global position in key order: one exchange of the rows, by range."""
    order = [F.col(k).asc_nulls_first() for k in ranges.keys]
    ranged = df.withColumn("_range", range_id(df, ranges))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    before = F.get(F.lit(ranges.offsets), F.col("_range"))
    return ranged.withColumn(name, inside - 1 + before.cast("bigint")).drop("_range")


@dataclass(frozen=True)
class Border:
    """A key, and how many rows of the same key lie before the position that was asked for."""

    key: Row
    skip: int


def key_at(df: DataFrame, ranges: KeyRanges, positions: Sequence[int]) -> list[Row | None]:
    """Exact order key at each 0-based position, without sorting the rows of the table."""
    return [found and found.key for found in borders_at(df, ranges, positions)]


def borders_at(df: DataFrame, ranges: KeyRanges, positions: Sequence[int]) -> list[Border | None]:
    """Order key at each 0-based position, and the position's place among the rows of that key.

    Each round cuts the key range that holds a position into smaller ranges, by value, until what
    is left is small enough to sort, or is one key; the driver receives borders and the one key.
    """
    return [_descend(df, ranges, position) for position in positions]


def _descend(df: DataFrame, ranges: KeyRanges, position: int) -> Border | None:
    if not 0 <= position < ranges.total:
        return None
    key = order_struct(df, ranges.keys)
    key_type = ranges.key_type
    while ranges.size > 1:
        at = max(i for i, before in enumerate(ranges.offsets) if before <= position)
        position -= ranges.offsets[at]
        if ranges.first[at] == ranges.last[at]:
            return Border(ranges.first[at], position)
        low = F.get(_key_array([ranges.first[at]], key_type), F.lit(0))
        high = F.get(_key_array([ranges.last[at]], key_type), F.lit(0))
        df = df.filter((key >= low) & (key <= high))
        if ranges.counts[at] <= LAST_STEP_ROWS:
            break
        ranges = key_ranges(df, ranges.keys, rows_per_range=LAST_STEP_ROWS // 2)
    counts = df.groupBy(key.alias("key")).agg(F.count("*").alias("n"))
    upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("key")))
    found = upto.filter(F.col("upto") > position).orderBy("key").limit(1).collect()
    return Border(found[0]["key"], position - (found[0]["upto"] - found[0]["n"])) if found else None


def _columns(df: DataFrame, keys: Sequence[str], border: Row) -> list[tuple[Column, Column | None]]:
    """Each key column with its value in the border, NULL as None."""
    kinds = [df.schema[k].dataType for k in keys]
    return [
        (F.col(_quoted(k)), None if v is None else _value(kind, v))
        for k, kind, v in zip(keys, kinds, border, strict=True)
    ]


def before_key(df: DataFrame, keys: Sequence[str], border: Row | None) -> Column:
    """True for rows ordered before ``border``; a missing border lies after every row.

    Written as plain comparisons of the columns, with the bound on the first column that they imply,
    so that it reaches the scan. NULL is ordered first.
    """
    if border is None:
        return F.lit(True)

    def less(pairs: list) -> Column:
        (column, value), *rest = pairs
        if value is None:
            return column.isNull() & less(rest) if rest else F.lit(False)
        found = (column < value) | column.isNull()
        return found | ((column == value) & less(rest)) if rest else found

    pairs = _columns(df, keys, border)
    column, value = pairs[0]
    if len(pairs) == 1 or value is None:
        return less(pairs)
    return ((column <= value) | column.isNull()) & less(pairs)


def from_key(df: DataFrame, keys: Sequence[str], border: Row | None) -> Column:
    """True for the rows that :func:`before_key` is not true for, written in the same way."""
    if border is None:
        return F.lit(False)

    def not_less(pairs: list) -> Column:
        (column, value), *rest = pairs
        if value is None:
            return column.isNotNull() | not_less(rest) if rest else F.lit(True)
        if not rest:
            return column >= value
        return (column > value) | ((column == value) & not_less(rest))

    pairs = _columns(df, keys, border)
    column, value = pairs[0]
    if len(pairs) == 1 or value is None:
        return not_less(pairs)
    return (column >= value) & not_less(pairs)


def at_key(df: DataFrame, keys: Sequence[str], border: Row) -> Column:
    """True for the rows of exactly this key."""
    same = [
        column.isNull() if value is None else column.eqNullSafe(value)
        for column, value in _columns(df, keys, border)
    ]
    return reduce(and_, same)


def neighbour(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    ranges: KeyRanges,
    step: int = -1,
    name: str = "neighbour",
) -> DataFrame:
    """Add the ``values`` of the previous (-1) or next (+1) row of the same group as a struct.

    ``ranges`` are cut over ``group + order``, so a group of any size is spread over as many tasks
    as it has ranges. The row beyond a border is the last row of the range before it (or the first
    of the range after it): one row per range, fetched by its known key.
    """
    group, order, values = list(group), list(order), list(values)
    ranged = df.withColumn("_range", range_id(df, ranges))
    window = Window.partitionBy(*group, "_range").orderBy(*order)
    shift = F.lag if step < 0 else F.lead
    # Column by column: a struct would travel through the exchange next to its own fields.
    beside = {f"_beside_{c}": shift(c).over(window) for c in values}
    out = ranged.withColumns(beside | {"_found": shift(F.lit(True), 1, False).over(window)})
    found = F.when(F.col("_found"), F.struct(*[F.col(f"_beside_{c}").alias(c) for c in values]))
    out = out.withColumn(name, found).drop("_found", *beside)
    if ranges.size == 1:
        return out.drop("_range")
    edges = _key_array(ranges.last if step < 0 else ranges.first, ranges.key_type)
    at_edge = order_struct(df, ranges.keys) == F.get(edges, F.col("_range"))
    carried = ranged.filter(at_edge).select(
        *group, (F.col("_range") - step).alias("_range"), F.struct(*values).alias("_carried")
    )
    joined = _join_groups(out, carried, group, "left")
    return joined.withColumn(name, F.coalesce(name, "_carried")).drop("_range", "_carried")


def _join_groups(rows: DataFrame, other: DataFrame, group: Sequence[str], how: str) -> DataFrame:
    """Join on group and range, where NULL equals NULL; the columns of ``rows`` keep their names."""
    named = other.withColumnsRenamed({c: f"_of_{c}" for c in group} | {"_range": "_of_range"})
    same = F.col("_range") == F.col("_of_range")
    for c in group:
        same = same & rows[c].eqNullSafe(F.col(f"_of_{c}"))
    return rows.join(named, same, how).drop("_of_range", *[f"_of_{c}" for c in group])


def running_sum(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: Column,
    ranges: KeyRanges,
    name: str,
    total: str | None = None,
) -> DataFrame:
    """Add the running sum of ``value`` in its group, and the group's whole sum as ``total``.

    Sums per group and range are combined before the exchange; a group has at most one such sum
    per range, so the second window stays small however large the group is.
    """
    group, order = list(group), list(order)
    ranged = df.withColumn("_range", range_id(df, ranges)).withColumn("_value", value)
    inside = (
        Window.partitionBy(*group, "_range")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = ranged.withColumn(name, F.sum("_value").over(inside))
    per_group = Window.partitionBy(*group)
    if ranges.size == 1:
        whole = Window.partitionBy(*group, "_range")
        out = out.withColumn(total, F.sum("_value").over(whole)) if total else out
        return out.drop("_range", "_value")
    earlier = per_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        ranged.groupBy(*group, "_range")
        .agg(F.sum("_value").alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .withColumn("_total", F.sum("_sum").over(per_group))
        .drop("_sum")
    )
    out = _join_groups(out, sums, group, "inner")
    out = out.withColumn(name, F.col(name) + F.col("_before"))
    if total:
        out = out.withColumnRenamed("_total", total)
    return out.drop("_range", "_value", "_before", "_total")
