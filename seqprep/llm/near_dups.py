"""Near duplicates: one-permutation MinHash with optimal densification, bands, stars.

A document's set is its distinct 5-word shingles, hashed to 64 bits. One permutation serves all
bins: the hash's top bits choose one of ``BINS`` bins and the bin keeps its least hash. An empty bin
takes the value of the first filled bin in its own fixed random order of bins, which is the same for
all documents. Runs of ``ROWS`` bins form bands; documents that agree on a band share a bucket.

Documents with equal sets are one node. A bucket links its nodes to one hub only, so it yields fewer
pairs than it has members. Each pair is confirmed on the full sets. A hub then leaves its bucket, and
buckets whose other members are not yet in one component choose another, by another order, as long as
a round settles half of them. What is in several components then is compared in blocks of a bucket,
member by member but without a row per pair, so every two nodes of a bucket are compared or known to
be connected.

Defined results: a NULL or wordless text has an empty set and is linked with nothing; a text of
fewer than five words is one shingle; repeated rows are each returned. A row without ``doc_id`` takes
part, and is kept only if no row of its component has an id. No rows give no rows. Columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.llm.components import components
from seqprep.llm.frames import bit_set, likely, text_bytes, without, written
from seqprep.llm.words import grams, mix, signed, word_lists

SHINGLE = 5
PERCENT = 75
#: 128 bins in 32 bands of 4: a pair of similarity 0.75 shares no band with probability 5e-6.
BIN_BITS = 7
BINS = 1 << BIN_BITS
ROWS = 4
#: Leaves that are compared with one copy of their hub.
LEAVES = 64
#: Members of a block on average, and shingles, whichever makes more blocks.
BLOCK = 256
BLOCK_SHINGLES = 1 << 20
#: Shingles of two blocks that are compared at once.
COLUMNS = 8192

_SIGNED = "doc_id bigint, _text bigint, n_shingles bigint, node binary, bands array<bigint>"


def shingles(words: np.ndarray) -> np.ndarray:
    """The sorted distinct shingle hashes of a text's words."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    return np.unique(grams(words, min(SHINGLE, len(words))))


def _probe(step: int) -> np.ndarray:
    """The ``step``-th bin that each bin would borrow from."""
    at = np.arange(BINS, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)
    return (mix(at + np.uint64(step * 2654435761 + 1)) >> np.uint64(64 - BIN_BITS)).astype(np.int64)


_PROBES = np.array([_probe(step) for step in range(256)])
_FACTORS = mix(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)
_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BIN_BITS)


def densified(found: np.ndarray) -> np.ndarray:
    """The value of every bin, for the sorted hashes of a set that is not empty."""
    first = np.searchsorted(found, _EDGES)
    filled = np.diff(np.append(first, len(found))) > 0
    values = found[np.minimum(first, len(found) - 1)]
    source, empty, step = np.arange(BINS), np.flatnonzero(~filled), 0
    while len(empty):
        bins = _PROBES[step] if step < len(_PROBES) else _probe(step)
        hit = filled[bins[empty]]
        source[empty[hit]] = bins[empty[hit]]
        empty, step = empty[~hit], step + 1
    return values[source]


def band_keys(found: np.ndarray) -> np.ndarray:
    """One key per band; the band's number is part of it."""
    parts = densified(found).reshape(-1, ROWS)
    total = (parts * _FACTORS).sum(axis=1, dtype=np.uint64)
    return mix(total + np.arange(len(parts), dtype=np.uint64))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, nodes, bands = [], [], []
        for words in word_lists(batch.column("_data").to_pylist()):
            found = shingles(words)
            sizes.append(len(found))
            nodes.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
            bands.append(signed(band_keys(found)) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("_text"),
                pa.array(sizes, pa.int64()),
                pa.array(nodes, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["doc_id", "_text", "n_shingles", "node", "bands"],
        )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted, each hub's own text before its leaves; the linked pairs."""
    hub, held = None, np.zeros(0, np.uint64)
    for batch in batches:
        hubs, nodes = batch.column("hub").to_pylist(), batch.column("node").to_pylist()
        kinds, pairs = batch.column("kind").to_pylist(), []
        for i, words in enumerate(word_lists(batch.column("_data").to_pylist())):
            found = shingles(words)
            if kinds[i] == 0:
                hub, held = hubs[i], found
                continue
            if hub != hubs[i]:
                raise ValueError("a leaf came without its hub")
            both = len(np.intersect1d(found, held, assume_unique=True))
            if 100 * both >= PERCENT * (len(found) + len(held) - both):
                pairs.append((hub, nodes[i]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())],
            ["u", "v"],
        )


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(hub, node)`` whose full sets are similar; a hub's leaves are spread."""
    degree = pairs.groupBy("hub").agg(F.count("*").alias("_degree"))
    salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("_degree") / LEAVES).cast("bigint"))
    placed = pairs.join(degree, "hub").select("hub", "node", salt.alias("salt"))
    leaves = placed.join(texts, "node").select("hub", "salt", F.lit(1).alias("kind"), "node", "_data")
    own = texts.select(F.col("node").alias("hub"), "_data")
    hubs = placed.select("hub", "salt").distinct().join(own, "hub")
    hubs = hubs.select("hub", "salt", F.lit(0).alias("kind"), F.col("hub").alias("node"), "_data")
    rows = hubs.unionByName(leaves).repartition("hub", "salt")
    return rows.sortWithinPartitions("hub", "salt", "kind").mapInArrow(_compare, "u binary, v binary")


def _rooted(nodes: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``nodes`` with the smallest node of their component so far as ``root``."""
    if roots is None:
        return nodes.withColumn("root", F.col("node"))
    up = roots.select(F.col("u").alias("node"), F.col("v").alias("_root"))
    return nodes.join(up, "node", "left").withColumn("root", F.coalesce("_root", "node")).drop("_root")


def _hubs(members: DataFrame, round_: int) -> DataFrame:
    """The hub of each bucket: ``node``, ``root`` and ``n`` in ``_hub``.

    The first hub is the member with the most company in all its buckets, which lies in the middle
    of a group of copies; later ones follow a seeded order.
    """
    first = F.xxhash64("node", F.lit(round_)) if round_ else -F.col("company")
    order = F.struct(first.alias("first"), "node", "root", "n")
    return members.groupBy("key").agg(F.min(order).alias("_hub"))


def _pairs(members: DataFrame, round_: int) -> DataFrame:
    """Star of each bucket: its hub and the members of other components."""
    star = members.join(_hubs(members, round_), "key").filter("root <> _hub.root")
    fits = F.least("n", "_hub.n") * 100 >= F.greatest("n", "_hub.n") * PERCENT
    return star.filter(fits).select(F.col("_hub.node").alias("hub"), "node").distinct()


def _unsettled(members: DataFrame, roots: DataFrame, round_: int) -> DataFrame:
    """Members but the round's hubs, of buckets that hold several components even so."""
    rest = members.join(_hubs(members, round_), "key").filter("node <> _hub.node")
    rest = _rooted(rest.drop("_hub", "root"), roots)
    ends = rest.groupBy("key").agg(F.min("root").alias("_low"), F.max("root").alias("_high"))
    return rest.join(ends.filter("_low <> _high").select("key"), "key", "left_semi")


def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of ``a`` with each of ``b``, ``COLUMNS`` values at a time."""
    values = [np.concatenate(sets) for sets in (a, b)]
    owners = [np.repeat(np.arange(len(sets)), [len(x) for x in sets]) for sets in (a, b)]
    known = np.intersect1d(*values)
    total, at = np.zeros((len(a), len(b)), np.int64), []
    for side in (0, 1):
        place = np.searchsorted(known, values[side])
        held = known[np.minimum(place, len(known) - 1)] == values[side] if len(known) else place < 0
        order = np.argsort(place[held], kind="stable")
        at.append((place[held][order], owners[side][held][order]))
    for start in range(0, len(known), COLUMNS):
        marks = []
        for sets, (place, owner) in zip((a, b), at):
            low, high = np.searchsorted(place, (start, start + COLUMNS))
            mark = np.zeros((len(sets), min(COLUMNS, len(known) - start)), np.float32)
            mark[owner[low:high], place[low:high] - start] = 1
            marks.append(mark)
        total += (marks[0] @ marks[1].T).astype(np.int64)
    return total


def _linked(a: list[tuple], b: list[tuple]) -> list[tuple[bytes, bytes]]:
    """Similar pairs of different components between members ``(node, root, set)`` of two blocks."""
    if not a or not b:
        return []
    number = {root: i for i, root in enumerate({m[1] for m in (*a, *b)})}
    roots = [np.array([number[m[1]] for m in side]) for side in (a, b)]
    sizes = [np.array([len(m[2]) for m in side]) for side in (a, b)]
    both = _common([m[2] for m in a], [m[2] for m in b])
    close = 100 * both >= PERCENT * (sizes[0][:, None] + sizes[1][None] - both)
    close &= roots[0][:, None] != roots[1][None]
    return [(a[i][0], b[j][0]) for i, j in np.argwhere(close)]


def _compare_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a cell come together; the linked pairs within its block or between its two."""
    cell, sides = None, ([], [])

    def pairs() -> pa.RecordBatch:
        alone = cell is not None and cell[1] == cell[2]
        found = _linked(sides[0], sides[0] if alone else sides[1])
        columns = [pa.array([p[side] for p in found], pa.binary()) for side in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, ["u", "v"])

    for batch in batches:
        names = ("key", "i", "j", "kind", "node", "root")
        rows = zip(*(batch.column(c).to_pylist() for c in names))
        for row, words in zip(rows, word_lists(batch.column("_data").to_pylist())):
            *place, kind, node, root = row
            if cell != place:
                yield pairs()
                cell, sides = place, ([], [])
            sides[kind].append((node, root, shingles(words)))
    yield pairs()


def _settle(members: DataFrame, texts: DataFrame) -> DataFrame:
    """All links between the components of each bucket, block against block.

    A bucket of ``k`` unsettled members makes about ``k * k / BLOCK`` rows and no row per pair. A
    task holds two blocks at a time.
    """
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    sizes = members.groupBy("key").agg(blocks.cast("bigint").alias("_of"))
    own, other = F.pmod(F.xxhash64("node"), F.col("_of")), F.explode(F.sequence(F.lit(0), F.col("_of") - 1))
    placed = members.join(sizes, "key").select("key", "node", "root", own.alias("_own"), other.alias("_other"))
    cells = placed.select(
        "key",
        F.least("_own", "_other").alias("i"),
        F.greatest("_own", "_other").alias("j"),
        (F.col("_own") > F.col("_other")).cast("int").alias("kind"),
        "node",
        "root",
    )
    rows = cells.join(texts, "node").repartition("key", "i", "j")
    return rows.sortWithinPartitions("key", "i", "j").mapInArrow(_compare_cells, "u binary, v binary")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``."""
    return _near_duplicates(docs).drop("_text", "root")


def _near_duplicates(docs: DataFrame) -> DataFrame:
    data = text_bytes(docs, F.xxhash64(F.col("text").cast("string")).alias("_text"))
    signs = written(data.mapInArrow(_sign, _SIGNED), "signatures")
    named = signs.filter("node is not null")
    nodes = named.groupBy("node").agg(
        F.min("doc_id").alias("first_id"),
        F.min(F.struct("doc_id", "_text")).alias("_text"),
        F.max("n_shingles").alias("n"),
        F.first("bands").alias("bands"),
    )
    nodes = written(nodes, "nodes")
    buckets = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1")
    members = written(buckets.join(shared, "key"), "buckets")
    company = members.groupBy("node").agg(F.sum("_n").alias("company"))
    members = written(members.drop("_n").join(company, "node"), "buckets")

    found = nodes.join(members.select("node").distinct(), "node", "left_semi")
    wanted = found.select("node", F.col("_text.doc_id").alias("_id"), F.col("_text._text").alias("_key"))
    near = likely(data, "_text", bit_set(wanted, "_key"))
    same = near["_text"].eqNullSafe(wanted["_key"]) & near["doc_id"].eqNullSafe(wanted["_id"])
    texts = written(near.join(wanted, same).select("node", "_data"), "texts")

    members, left = _rooted(members, None), members.count()
    roots, tried, round_ = None, None, 0
    while True:
        pairs = _pairs(members, round_)
        if tried is not None:
            same = (F.least("hub", "node") == F.col("_a")) & (F.greatest("hub", "node") == F.col("_b"))
            pairs = pairs.join(tried, same, "left_anti")
        pairs = written(pairs, "pairs")
        links = written(_confirm(pairs, texts), "confirmed")
        roots = components(links if roots is None else links.unionByName(roots))
        members = written(_unsettled(members, roots, round_), "unsettled")
        before, left = left, members.count()
        if not left or 2 * left > before:
            break
        seen = pairs.select(F.least("hub", "node").alias("_a"), F.greatest("hub", "node").alias("_b"))
        tried = seen if tried is None else tried.unionByName(seen)
        round_ += 1
    links = written(_settle(members, texts), "settled")
    if not links.isEmpty():
        roots = components(links.unionByName(roots))
    rooted = _rooted(nodes.select("node", "first_id"), roots)
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_node = rooted.select("node", "root").join(first, "root").select("node", "root", "component_id")
    out = signs.select("doc_id", "_text", "n_shingles", "node").join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", "_text", "n_shingles", component.alias("component_id"), "root")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.withColumn("kept", kept)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group; columns as they were.

    The row with the least id stays (one without an id if all are), of several with that id the one
    with the least text hash, and of equal ones any. Groups are told apart by their root, as unrelated
    texts may carry one id. Rows without words all stay. The texts are joined by sorting at every
    size, so a small table runs the plan of a large one.
    """
    found = written(_near_duplicates(docs), "near_dups").filter("root is not null")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "_text")
    firsts = found.groupBy("root").agg(F.min(order).alias("_first"), F.count("*").alias("_n"))
    firsts = firsts.filter("_n > 1").select(F.col("root").alias("_of"), "_first")
    named = found.join(firsts, found["root"] == F.col("_of"))
    first = F.col("doc_id").eqNullSafe(F.col("_first.doc_id")) & F.col("_text").eqNullSafe(F.col("_first._text"))
    groups = named.groupBy("doc_id", "_text").agg(F.max(first).alias("first"), F.count("*").alias("n"))
    groups = written(groups, "groups")
    gone = groups.filter("not first").select("doc_id", "_text")
    equal = groups.filter("first and n > 1").select("doc_id", "_text")
    if equal.isEmpty():
        return without(docs, gone.hint("merge"))
    once = without(docs, gone.unionByName(equal).hint("merge"))
    return once.unionByName(without(docs, equal, "left_semi").dropDuplicates(["doc_id", "text"]))
