"""Benchmark decontamination by winnowing.

Of every seven consecutive 7-grams of words the least hash is a fingerprint, so any 13 words that a
document shares with an item hold a fingerprint of both, at the same place. Fingerprints carry the
hashes of the six words on either side; a match of fingerprints is extended over them, and a run of
13 words or more is a hit. An item of fewer than 13 words is one window; its own fingerprint is its
whole sequence, looked up at every position of a document.

Places of a document with the same fingerprint and sides are one, with a list of places, and so are items
with the same; each pair of different sides is extended once, and its reach laid on all places. A text of one
word repeated thus costs a few pairs, not the product of its places with an item's.

Fingerprints of documents first pass a bit set of fixed size made from the benchmark's;
what passes is joined with them. The bit set only saves shuffling: a benchmark of any size gives the
same result.

Defined results: NULL and wordless texts have no words, no hits, and are not contaminated; a
wordless item has no window; an item without ``item_id`` marks words but is not counted or listed;
items that share an id count once; repeated rows are each returned, with or without ``doc_id``. An
empty benchmark gives no hits, no documents no rows. No other columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.llm.frames import bit_set, passing, text_bytes, without, written
from seqprep.llm.words import PUNCTUATION, grams, minimisers, signed, word_lists

WINDOW = 13
GRAM = 7
SPAN = WINDOW - GRAM + 1
SIDE = WINDOW - GRAM
#: A document is contaminated from this share of its words, one in so many.
SHARE = 20
_SHORT = np.uint64(0x5DEECE66D1234567)

_HIT = "struct<key:bigint, size:int, side:binary, places:array<int>>"
_DOC = f"doc_id bigint, _text bigint, n_words bigint, hits array<{_HIT}>"
_ITEM = f"item_id string, n_words bigint, hits array<{_HIT}>"


def _sides(words: np.ndarray, at: int, size: int) -> bytes:
    """Count of words on the left, then up to ``SIDE`` word hashes left and right."""
    left, right = words[max(0, at - SIDE) : at], words[at + size : at + size + SIDE]
    return bytes([len(left)]) + left.tobytes() + right.tobytes()


Hits = dict[tuple[int, int, bytes], list[int]]


def _struct(groups: list[Hits]) -> pa.Array:
    """Per text its fingerprints: key, number of words (0 for a winnowed one), sides and places."""
    kind = pa.struct(
        [("key", pa.int64()), ("size", pa.int32()), ("side", pa.binary()), ("places", pa.list_(pa.int32()))]
    )
    rows = [
        [{"key": k, "size": n, "side": s, "places": places} for (k, n, s), places in group.items()]
        for group in groups
    ]
    return pa.array(rows, pa.list_(kind))


def _winnowed(words: np.ndarray, keys: np.ndarray, at: np.ndarray) -> Hits:
    found: Hits = {}
    for key, place in zip(signed(keys).tolist(), at.tolist()):
        found.setdefault((key, 0, _sides(words, place, GRAM)), []).append(place)
    return found


def _fingerprints(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = grams(words, GRAM)
    at = minimisers(values, SPAN)
    return values[at], at


def _of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, hits = [], []
        for words in word_lists(batch.column("_data").to_pylist(), PUNCTUATION):
            counts.append(len(words))
            if len(words) >= WINDOW:
                hits.append(_winnowed(words, *_fingerprints(words)))
            elif len(words):
                key = signed(grams(words, len(words)) ^ _SHORT)
                hits.append({(int(key[0]), len(words), b""): [0]})
            else:
                hits.append({})
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array(counts, pa.int64()), _struct(hits)],
            ["item_id", "n_words", "hits"],
        )


def _of_documents(bits: bytes, lengths: list[int]):
    """Fingerprints of documents that pass the bit set; ``lengths``: of the short items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bits, np.uint8)

        for batch in batches:
            counts, hits = [], []
            for words in word_lists(batch.column("_data").to_pylist(), PUNCTUATION):
                counts.append(len(words))
                keys, at = _fingerprints(words)
                found = np.flatnonzero(passing(known, keys))
                group = _winnowed(words, keys[found], at[found])
                for n in lengths:
                    keys = grams(words, n) ^ _SHORT
                    found = np.flatnonzero(passing(known, keys))
                    for key, place in zip(signed(keys[found]).tolist(), found.tolist()):
                        group.setdefault((key, n, b""), []).append(place)
                hits.append(group)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_text"), pa.array(counts, pa.int64()), _struct(hits)],
                ["doc_id", "_text", "n_words", "hits"],
            )

    return run


def _run(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common start."""
    n = min(len(a), len(b))
    other = np.flatnonzero(a[:n] != b[:n])
    return int(other[0]) if len(other) else n


_REACH = "_row bigint, _hit int, key bigint, size int, places array<int>, item_side binary, low int, high int"


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of sides to how far a match reaches from its place, ``[low, high)``; short ones go."""

    def split(side: bytes) -> tuple[np.ndarray, np.ndarray]:
        words = np.frombuffer(side, np.uint64, offset=1)
        return words[: side[0]][::-1], words[side[0] :]

    for batch in batches:
        kept, lows, highs = [], [], []
        cells = [batch.column(c).to_pylist() for c in ("size", "side", "item_side")]
        for i, (size, side, item_side) in enumerate(zip(*cells)):
            low, high = 0, size
            if not size:
                (left, right), (item_left, item_right) = split(side), split(item_side)
                low, high = -_run(left, item_left), GRAM + _run(right, item_right)
                if high - low < WINDOW:
                    continue
            for to, x in zip((kept, lows, highs), (i, low, high)):
                to.append(x)
        some = batch.take(pa.array(kept, pa.int32()))
        columns = [some.column(c) for c in ("_row", "_hit", "key", "size", "places", "item_side")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(lows, pa.int32()), pa.array(highs, pa.int32())],
            [part.split()[0] for part in _REACH.split(", ")],
        )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: its words, hit words, items, their digest and the verdict."""
    return _contamination(docs, benchmark).drop("_text")


def _contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"),
        F.col("text").cast("string").cast("binary").alias("_data"),
    ).mapInArrow(_of_items, _ITEM)
    items = items.select("item_id", F.explode("hits").alias("hit"))
    items = written(
        items.select("item_id", "hit.key", "hit.size", F.col("hit.side").alias("item_side")).distinct(), "items"
    )
    sides = items.select("key", "size", "item_side").distinct()
    short = items.filter("size > 0").select("size").distinct().collect()
    lengths = sorted(row["size"] for row in short)
    run = _of_documents(bit_set(items, "key"), lengths)
    found = text_bytes(docs, F.xxhash64(F.col("text").cast("string")).alias("_text")).mapInArrow(run, _DOC).withColumn("_row", F.monotonically_increasing_id())
    found = written(found, "fingerprints")
    hits = found.select("_row", F.posexplode("hits").alias("_hit", "hit")).select("_row", "_hit", "hit.*")
    pairs = hits.join(sides, ["key", "size"])
    reaches = written(pairs.mapInArrow(_extend, _REACH), "reaches")
    same = [F.col("_item." + c).eqNullSafe(F.col("_reach." + c)) for c in ("key", "size", "item_side")]
    of_items = reaches.drop("places", "low", "high").alias("_reach").join(items.alias("_item"), same[0] & same[1] & same[2])
    listed = of_items.select("_row", "item_id").distinct().groupBy("_row").agg(
        F.count("item_id").alias("n_items"),
        F.concat_ws(",", F.sort_array(F.collect_list("item_id"))).alias("_items"),
    )
    # All matches of a place hold its fingerprint, so their union is one span.
    widest = reaches.groupBy("_row", "_hit").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.first("places").alias("places")
    )
    spans = widest.select(
        "_row",
        F.transform(
            "places", lambda at: F.struct((at + F.col("low")).alias("low"), (at + F.col("high")).alias("high"))
        ).alias("spans"),
    )
    covered = (
        spans.groupBy("_row")
        .agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("_spans"))
        .select("_row", _covered(F.col("_spans")).alias("n_hit"))
    )
    out = found.drop("hits").join(covered, "_row", "left").join(listed, "_row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return out.select(
        "doc_id",
        "_text",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce("_items", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def _covered(spans):
    """Number of words in the union of sorted spans."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))

    def step(state, span):
        low = F.greatest(span["low"], state["reach"])
        more = F.greatest(span["high"] - low, F.lit(0))
        return F.struct((state["n"] + more).alias("n"), F.greatest(state["reach"], span["high"]).alias("reach"))

    return F.aggregate(spans, start, step, lambda state: state["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated; columns as they were.

    Their keys are few, so Spark broadcasts them unless their size says otherwise.
    """
    found = _contamination(docs, benchmark).filter("contaminated").select("doc_id", "_text")
    return without(docs, written(found.distinct(), "contaminated"))
