"""Repeated passages across documents, by a sparse suffix array over words.

Suffixes are kept at minimisers only: positions whose 8-gram of words has the least hash of 25
neighbouring ones. Any 50 words hold such a position among their first 25, chosen by those words
alone, so equal passages keep equal suffixes, which then agree on at least 26 more words. Suffixes
whose first 26 words (by hash) occur in one document only are dropped; the rest are sorted by their
words, equal ones counted once, and each is compared with its neighbours in the order, to the right
and, word by word backwards, to the left. A match of ``SPAN`` words or more is extended to the ends of
the kept context; the union of a document's matches are its repeated spans.

The suffixes are sorted over value ranges, so a passage that a third of all documents share is
spread; neighbours across a border are one suffix per range. Words are compared by 32 bits of their
hash within a context, by 64 for the first 26.

A neighbour shares the longest part to the right, which may not be the part that makes ``SPAN`` words
with what lies to the left. So where three or more distinct contexts share their first 26 words, the
windows of ``SPAN`` words that chose a suffix (25 at most) are hashed too, and those seen in two
documents are matches. Every repeat of ``SPAN`` words is such a window.

Defined results: a NULL text, or one shorter than ``SPAN`` words, has no spans; rows equal in
``doc_id`` and text are one document; repeats inside one document are not reported; a row without
``doc_id`` takes part and has NULL for its id. An empty table gives no rows. No other columns are
read. Words are runs of signs other than ASCII white space, case kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.llm.frames import bit_set, likely, text_bytes, written
from seqprep.llm.words import grams, minimisers, mix, signed, word_lists
from seqprep.plans.storage import cut_lineage

SPAN = 50
GRAM = 8
WINDOW = 25
PREFIX = SPAN - WINDOW + 1
LEFT = WINDOW - 1
#: Words kept after the prefix; the last kept suffix of a passage reaches its end with these.
TAIL = WINDOW + 1
#: Sorted suffixes of a range.
RANGE_ROWS = 50_000

_CONTEXT = "key bigint, tail binary, back binary, who bigint, doc_id bigint, at int, least int, most int"


def anchors(words: np.ndarray) -> np.ndarray:
    """Positions of the kept suffixes with at least ``PREFIX`` words."""
    at = minimisers(grams(words, GRAM), WINDOW)
    return at[at <= len(words) - PREFIX]


def _keys(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return signed(grams(words, PREFIX)[at]) if len(at) else np.zeros(0, np.int64)


def _chosen(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and most words before each anchor in the windows of ``SPAN`` words that chose it."""
    values = grams(words, GRAM)
    if len(words) < SPAN or not len(at):
        return np.ones(len(at), np.int64), np.zeros(len(at), np.int64)
    view = np.lib.stride_tricks.sliding_window_view(values, WINDOW)[: len(words) - SPAN + 1]
    by = view.argmin(axis=1) + np.arange(len(view))
    return at - np.searchsorted(by, at, "right") + 1, at - np.searchsorted(by, at, "left")


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, places = [], []
        for words in word_lists(batch.column("_data").to_pylist(), lower=False):
            at = anchors(words)
            keys.append(_keys(words, at))
            places.append(at.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("who"),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(places, pa.list_(pa.int32())),
            ],
            ["doc_id", "who", "keys", "places"],
        )


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted suffixes of each text: words after the prefix, and words before it, backwards."""
    for batch in batches:
        texts = word_lists(batch.column("_data").to_pylist(), lower=False)
        wanted = batch.column("places").to_pylist()
        whos, ids = batch.column("who").to_pylist(), batch.column("doc_id").to_pylist()
        out: list[list] = [[] for _ in range(8)]
        for words, places, who, doc_id in zip(texts, wanted, whos, ids):
            least, most = _chosen(words, np.array(places, np.int64))
            keys = _keys(words, np.array(places, np.int64)).tolist()
            small = (words >> np.uint64(32)).astype(">u4")
            for key, at, low, high in zip(keys, places, least.tolist(), most.tolist()):
                end = at + PREFIX
                row = (key, small[end : end + TAIL].tobytes(), small[max(0, at - LEFT) : at][::-1].tobytes())
                for to, x in zip(out, (*row, who, doc_id, at, low, high)):
                    to.append(x)
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()] + [pa.int32()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(out, kinds)],
            ["key", "tail", "back", "who", "doc_id", "at", "least", "most"],
        )


def _matrix(cells: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of each cell in a row, and how many there are."""
    out = np.zeros((len(cells), width), ">u4")
    sizes = np.array([len(c) // 4 for c in cells], np.int64)
    for i, cell in enumerate(cells):
        out[i, : sizes[i]] = np.frombuffer(cell, ">u4")
    return out, sizes


def _common(words: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of rows ``a`` and ``b``."""
    same = words[a] == words[b]
    return np.minimum(np.cumprod(same, axis=1).sum(axis=1), np.minimum(sizes[a], sizes[b]))


def _neighbours(first: dict[int, tuple], last: dict[int, tuple]) -> Callable:
    """Compares sorted suffixes; ``first`` and ``last`` are the ends of the other ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        part = None
        for batch in batches:
            if batch.num_rows and part is None:
                part = batch.column("part")[0].as_py()
            cells = [batch.column(c).to_pylist() for c in ("cid", "key", "tail", "back", "low", "high")]
            rows += zip(*cells)
        if part is None:
            return
        before = max((p for p in last if p < part), default=None)
        after = min((p for p in first if p > part), default=None)
        rows = ([] if before is None else [last[before]]) + rows + ([] if after is None else [first[after]])
        own = np.arange(before is not None, len(rows) - (after is not None))
        cid, key = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
        low, high = (np.array([r[i] for r in rows], np.int64) for i in (4, 5))
        tails, backs = _matrix([r[2] for r in rows], TAIL), _matrix([r[3] for r in rows], LEFT)
        # Runs of suffixes of one and the same document are no repeats of each other.
        single = low == high
        joined = np.zeros(len(rows), bool)
        joined[1:] = single[1:] & single[:-1] & (low[1:] == low[:-1])
        starts = np.flatnonzero(~joined)
        run_of = np.searchsorted(starts, np.arange(len(rows)), "right") - 1
        ends = np.append(starts[1:], len(rows))
        previous, following = starts[run_of] - 1, ends[run_of]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for other in (previous, following):
            mine = own[(other[own] >= 0) & (other[own] < len(rows))]
            mine = mine[key[mine] == key[other[mine]]]
            left = _common(*backs, mine, other[mine])
            right = PREFIX + _common(*tails, mine, other[mine])
            far = left + right >= SPAN
            found.append((cid[mine[far]], left[far], right[far]))
        mine = own[~single[own]]
        left, right = backs[1][mine], PREFIX + tails[1][mine]
        far = left + right >= SPAN
        found.append((cid[mine[far]], left[far], right[far]))
        cids, lefts, rights = (np.concatenate(x) for x in zip(*found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cids), pa.array(lefts.astype(np.int32)), pa.array(rights.astype(np.int32))],
            ["cid", "l", "r"],
        )

    return run


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows that chose each suffix, and how many of their words lie before it."""
    before = np.arange(LEFT + 1)
    for batch in batches:
        sums = []
        for side, (name, width) in enumerate((("back", LEFT), ("tail", TAIL))):
            cells, _ = _matrix(batch.column(name).to_pylist(), width)
            places = mix(np.arange(1, width + 1, dtype=np.uint64) + np.uint64(side << 32))
            total = np.zeros((len(cells), width + 1), np.uint64)
            np.cumsum(mix(cells.astype(np.uint64) + places), axis=1, out=total[:, 1:])
            sums.append(total)
        keys, cid, low, high, least, most = (
            batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
            for c in ("key", "cid", "low", "high", "least", "most")
        )
        starts = mix(mix(keys.view(np.uint64))[:, None] + before.astype(np.uint64))
        hashes = signed(mix(starts + mix(sums[0][:, before]) + sums[1][:, LEFT - before]))
        row, n = np.nonzero((before >= least[:, None]) & (before <= most[:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (hashes[row, n], cid[row], low[row], high[row], n.astype(np.int32))],
            ["window", "cid", "low", "high", "n"],
        )


def _window_matches(distinct: DataFrame) -> DataFrame:
    """``(cid, l, r)``: the stretch of all windows around a suffix that two documents hold.

    All windows of a suffix hold its first word, so their union is one stretch. A suffix of several
    documents is matched whole and only helps to find others.
    """
    crowded = distinct.groupBy("key").count().filter("count > 2").select("key")
    rows = distinct.join(crowded, "key", "left_semi").filter("least <= most")
    rows = rows.select("key", "tail", "back", "cid", "low", "high", "least", "most")
    kinds = "window bigint, cid bigint, low bigint, high bigint, n int"
    ends = rows.mapInArrow(_windows, kinds).groupBy("window").agg(F.min("low").alias("_low"), F.max("high").alias("_high"))
    shared = ends.filter("_low <> _high").select("window")
    own = rows.filter("low = high").mapInArrow(_windows, kinds).select("window", "cid", "n")
    found = own.join(shared, "window").groupBy("cid")
    return found.agg(F.max("n").alias("l"), (F.lit(SPAN) - F.min("n")).alias("r"))


def _merged(spans: Column) -> Column:
    """Sorted spans as disjoint ones: the open span at the end of the state, others before it."""
    none = F.array().cast("array<struct<low:int,high:int>>")

    def step(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        wider = F.struct(last["low"].alias("low"), F.greatest(last["high"], span["high"]).alias("high"))
        fresh = F.concat(done, F.array(F.struct(span["low"].alias("low"), span["high"].alias("high"))))
        meets = last.isNotNull() & (span["low"] <= last["high"])
        return F.when(meets, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wider))).otherwise(fresh)

    return F.aggregate(spans, none, step)


def _matches(suffixes: DataFrame) -> DataFrame:
    """``(cid, l, r)``: words matched before and from the start of each distinct suffix."""
    distinct = suffixes.groupBy("cid").agg(
        F.first("key").alias("key"),
        F.first("tail").alias("tail"),
        F.first("back").alias("back"),
        F.min("who").alias("low"),
        F.max("who").alias("high"),
        F.first("least").alias("least"),
        F.first("most").alias("most"),
    )
    distinct = written(distinct, "suffixes")
    ranges = max(1, math.ceil(distinct.count() / RANGE_ROWS))
    order = ["key", "tail", "back", "cid"]
    ordered = distinct.drop("least", "most").repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    ordered = cut_lineage(ordered).withColumn("part", F.spark_partition_id())
    edge = F.struct("key", "tail", "back", "cid", "low", "high")
    ends = ordered.groupBy("part").agg(F.min(edge).alias("first"), F.max(edge).alias("last")).collect()
    cells = ("cid", "key", "tail", "back", "low", "high")
    first, last = (
        {e["part"]: tuple(bytes(v) if isinstance(v, bytearray) else v for v in (e[side][c] for c in cells)) for e in ends}
        for side in ("first", "last")
    )
    matched = ordered.mapInArrow(_neighbours(first, last), "cid bigint, l int, r int")
    return matched.unionByName(_window_matches(distinct))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Per repeated span: ``doc_id``, its words ``[start_word, end_word)``, and ``first_id``.

    ``first_id`` is the least id of a document that shares some of it. The driver receives two
    suffixes of 200 bytes per range of ``RANGE_ROWS``.
    """
    data = text_bytes(docs, F.xxhash64("doc_id", "text").alias("who"))
    sampled = data.mapInArrow(_sample, "doc_id bigint, who bigint, keys array<bigint>, places array<int>")
    sampled = written(sampled.filter("size(keys) > 0"), "anchors")
    pairs = F.explode(F.arrays_zip("keys", "places"))
    rows = sampled.select("doc_id", "who", pairs.alias("p")).select("doc_id", "who", "p.keys", "p.places")
    shared = rows.groupBy("keys").agg(
        F.min("who").alias("_low"), F.max("who").alias("_high"), F.min("doc_id").alias("first_id")
    )
    shared = written(shared.filter("_low <> _high").select(F.col("keys").alias("key"), "first_id"), "shared")
    wanted = rows.join(shared, rows["keys"] == shared["key"]).select("who", "places").distinct()
    wanted = wanted.groupBy("who").agg(F.sort_array(F.collect_list("places")).alias("places"))
    wanted = written(wanted, "places")
    texts = likely(data, "who", bit_set(wanted, "who"))
    texts = texts.dropDuplicates(["doc_id", "who"]) if _repeats(sampled) else texts
    texts = texts.join(wanted.withColumnRenamed("who", "_who"), texts["who"] == F.col("_who")).drop("_who")
    suffixes = texts.select("doc_id", "who", "_data", "places").mapInArrow(_contexts, _CONTEXT)
    suffixes = written(suffixes.withColumn("cid", F.xxhash64("key", "tail", "back")), "contexts")
    matched = _matches(suffixes)
    spans = suffixes.select("cid", "key", "who", "doc_id", "at").join(matched, "cid").join(shared, "key")
    spans = spans.groupBy("who", "doc_id").agg(
        F.sort_array(F.collect_set(F.struct((F.col("at") - F.col("l")).alias("low"), (F.col("at") + F.col("r")).alias("high")))).alias("spans"),
        F.min("first_id").alias("first_id"),
    )
    out = spans.select("doc_id", "first_id", F.explode(_merged(F.col("spans"))).alias("s"))
    return out.select(
        "doc_id",
        F.col("s.low").alias("start_word"),
        F.col("s.high").alias("end_word"),
        (F.col("s.high") - F.col("s.low")).alias("n_words"),
        "first_id",
    )


def _repeats(sampled: DataFrame) -> bool:
    return not sampled.groupBy("doc_id", "who").count().filter("count > 1").isEmpty()
