"""How filters interact: what each order of them removes at each step, by decision diagrams.

Every document gets a mask of the filters it fails. Masks are counted per part, so that a part is at
most ``2 ** n`` counts whatever its size. A part's counts become a decision diagram: a level per
filter, a node's low edge for documents that pass, its high edge for those that fail, and on every
node the number of documents below it. Swapping two adjacent levels gives the diagram of the order
with these two filters exchanged; a chain of such swaps visits all orders. In each order the path of
low edges, where all filters so far pass, is the run of the filters: the weight of a high edge
hanging off it is what that step removes.

Defined results: a NULL text counts as empty; a NULL source is the part ``''``, as an empty one; a
document is a copy if a row of a smaller ``doc_id`` has the same text anywhere in the table, so rows
without an id are never copies and make none; repeated rows count each; several labels of a
``doc_id`` count as one, good or toxic if any of them is. No documents give no rows. Only
``doc_id``, ``text`` and ``source``, and ``doc_id``, ``quality`` and ``toxic`` of the labels, are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.llm.frames import WORD

MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
SIGNS = "#$%&*|"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Filters of the audit, in order of their bits; the last one compares rows.
NAMES = "ABCDE"
#: An audit lists the orders of all filters, ``n!`` of them.
MAX_FILTERS = 7

_GAP = WORD.replace("^", "", 1)
_STEP = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)

Weight = tuple[int, int, int]


class Diagram:
    """A count-weighted decision diagram. Equal subdiagrams are one node; no node stands for none."""

    def __init__(self, counts: Mapping[int, Weight], filters: int) -> None:
        self.order = list(range(filters))
        self.kept: dict[tuple, tuple] = {}
        self.root = self._grow(counts, 0, 0)

    def _grow(self, counts: Mapping[int, Weight], mask: int, level: int) -> tuple | None:
        if level == len(self.order):
            found = counts.get(mask)
            return found and self._node(found, None, None)
        low = self._grow(counts, mask, level + 1)
        return self._join(low, self._grow(counts, mask | 1 << level, level + 1))

    def _node(self, weight: Weight, low: tuple | None, high: tuple | None) -> tuple:
        return self.kept.setdefault((weight, id(low), id(high)), (weight, low, high))

    def _join(self, low: tuple | None, high: tuple | None) -> tuple | None:
        if low is None and high is None:
            return None
        return self._node(tuple(a + b for a, b in zip(_weight(low), _weight(high))), low, high)

    def swap(self, level: int) -> None:
        """Exchange ``level`` with the next one: each node there trades its inner grandchildren."""
        done: dict[int, tuple | None] = {}

        def moved(node: tuple | None, depth: int) -> tuple | None:
            if node is None:
                return None
            if id(node) not in done:
                _, low, high = node
                if depth < level:
                    done[id(node)] = self._join(moved(low, depth + 1), moved(high, depth + 1))
                else:
                    (_, ll, lh), (_, hl, hh) = low or _NONE, high or _NONE
                    done[id(node)] = self._join(self._join(ll, hl), self._join(lh, hh))
            return done[id(node)]

        self.root = moved(self.root, 0)
        self.order[level : level + 2] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, Weight, Weight]]:
        """Along the path on which all pass: filter, weight it removes, weight it leaves."""
        node = self.root
        for name in self.order:
            _, low, high = node or _NONE
            yield name, _weight(high), _weight(low)
            node = low


_NONE = ((0, 0, 0), None, None)


def _weight(node: tuple | None) -> Weight:
    return (node or _NONE)[0]


def swaps(n: int) -> Iterator[int]:
    """Levels to swap, one after the other, to visit every order of ``n`` filters once."""
    if n < 2:
        return
    inner = swaps(n - 1)
    down = True
    for _ in range(factorial(n - 1)):
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        # The last filter now stands at one end, which moves the others by one place or none.
        step = next(inner, None)
        if step is not None:
            yield step + down
        down = not down


def audit_part(counts: Mapping[int, Weight], names: str) -> list[tuple]:
    """All orders of one part: order, step and the counts of a result row after ``part``."""
    n = len(names)
    diagram = Diagram(counts, n)
    fails = [sum(w[0] for mask, w in counts.items() if mask >> f & 1) for f in range(n)]
    alone = [counts.get(1 << f, (0, 0, 0))[0] for f in range(n)]
    share, found = [0] * n, []
    for level in [None, *swaps(n)]:
        if level is not None:
            diagram.swap(level)
        order = "".join(names[f] for f in diagram.order)
        for step, (f, gone, left) in enumerate(diagram.steps(), 1):
            share[f] += gone[0]
            found.append((order, step, left[0], gone[0], fails[f] - gone[0], alone[f], *gone[1:], f))
    return [(*row, share[f]) for *row, f in found]


def _audited(names: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = {c["mask"]: (c["n"], c["good"], c["toxic"]) for c in row["counts"]}
                out = [(row["part"], *found) for found in audit_part(counts, names)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.string() if i < 2 else pa.int32() if i == 2 else pa.int64())
                     for i, column in enumerate(zip(*out))],
                    [name.split()[0] for name in _STEP.split(", ")],
                )

    return run


def audit(masks: DataFrame, names: Sequence[str]) -> DataFrame:
    """Audit rows ``(part, mask, n, good, toxic)``: bit ``i`` of ``mask`` is a failure of ``names[i]``.

    ``n`` documents of such a row have the mask, ``good`` and ``toxic`` of them a label. Rows may
    repeat a part and mask; they are added up before anything is gathered, and what is gathered of a
    part is one entry per mask. Returns a row per part, order and step.
    """
    if not 0 < len(names) <= MAX_FILTERS:
        raise ValueError(f"an audit takes 1 to {MAX_FILTERS} filters")
    sums = masks.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    parts = sums.filter("n > 0").groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts")
    )
    return parts.mapInArrow(_audited("".join(names)), _STEP)


def failures(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``part``, the text's SHA-256 and the mask of the filters A to D."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        F.array_remove(F.split(text, _GAP), "").alias("words"),
    )
    words, size = F.size("words"), F.char_length("text")
    capitals = size - F.char_length(F.translate("text", CAPITALS, ""))
    failed = [
        words < MIN_WORDS,
        F.size(F.array_distinct("words")) * 100 < words * DISTINCT_PERCENT,
        capitals.cast("bigint") * 100 > size.cast("bigint") * CAPITAL_PERCENT,
        F.col("text").rlike(f"[{SIGNS}]"),
    ]
    return rows.select(
        "doc_id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        _mask(failed).alias("mask"),
    )


def _mask(failed: Sequence[Column]) -> Column:
    bits = [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)]
    return sum(bits[1:], bits[0])


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters A to E over ``docs``, in all their orders, for every source.

    Texts stay where they are read; a row leaves as a digest and a mask. Copies of a text in a part
    become one row with the smallest id among them before the smallest id of all is joined to it, so
    a group of copies costs a row per part and label however large it is.
    """
    marked = labels.groupBy(F.col("doc_id").cast("bigint").alias("_of")).agg(
        F.max((F.col("quality") == 1).cast("bigint")).alias("good"),
        F.max((F.col("toxic") == 1).cast("bigint")).alias("toxic"),
    )
    rows = failures(docs)
    rows = rows.join(marked, rows["doc_id"] == marked["_of"], "left")
    own = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    same = ["digest", "part", "mask", "good", "toxic"]
    # One row per id and text, then one per text, part and label.
    by_id = rows.select("doc_id", "digest", "part", "mask", *own).groupBy("doc_id", *same).agg(
        F.count("*").alias("times")
    )
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "times"))
    groups = by_id.groupBy(*same).agg(
        F.sum("times").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("times")).otherwise(0)).alias("unnamed"),
        F.min(named).alias("least"),
    )
    first = groups.groupBy(F.col("digest").alias("_digest")).agg(F.min("least.doc_id").alias("first"))
    groups = groups.join(first, groups["digest"] == first["_digest"])
    is_first = F.col("least.doc_id") == F.col("first")
    kept = F.col("unnamed") + F.when(is_first, F.col("least.times")).otherwise(0)
    split = groups.select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct(F.col("mask"), kept.alias("n")),
                F.struct((F.col("mask") + (1 << NAMES.index("E"))).alias("mask"), (F.col("n") - kept).alias("n")),
            )
        ).alias("of"),
    )
    n = F.col("of.n")
    masks = split.select(
        "part", "of.mask", "of.n", (n * F.col("good")).alias("good"), (n * F.col("toxic")).alias("toxic")
    )
    return audit(masks, NAMES)
