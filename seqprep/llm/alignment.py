"""Two tokenizers aligned: groups of tokens between shared cuts, and links inside the groups.

Both tokenizers cut the same bytes. A place where a token of each ends is a shared cut, and the tokens
between two neighbouring shared cuts are a group. Groups come from dividing: of an interval between
two shared cuts, the one nearest to its middle is located by bisecting the other side's ends for ends
near the middle; both halves are divided again, and an interval without an inner cut is a leaf, a
group. All intervals of one depth, of many documents, are divided at once with numpy.

Encoding is by the libraries. A text is encoded in units that start at a space after another sign, each
distinct unit once while a task keeps it, where both tokenizers are of a kind for which a token always
starts there; other tokenizers get whole texts.

Pairs of ids linked in a document are written down once per document and counted over the corpus. The
most frequent ``HEAD`` pairs, whole bands of equal counts, are sent to the tasks and looked up there;
the other pairs of a document are exchanged and joined with their counts. So every pair gets its exact
count, and what is sent has a bound.

Defined results: a text that is NULL, empty or not UTF-8, or whose tokens do not join to the text with a space in
front, has no tokens, all zeros and an empty digest; every row counts as a document of its own, also
a repeated one or one without an id. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seqprep.llm.frames import text_bytes, written

FOLDER = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"
#: Signs of text aligned at once, and those of the units that a worker keeps.
CHUNK = 1 << 20
KEPT_SIGNS = 4_000_000
#: Probes on each side of an interval's middle before all its ends are bisected at once.
NEAR = 8
#: Links of a group above which equal ids of a side are counted before they are paired.
WIDE = 4096
#: Pairs whose counts are sent to the tasks, 17 bytes each; bands of counts to find them, per doubling.
HEAD = 1 << 18
BANDS = 8

#: From a space after another sign up to the next such space.
_UNIT = re.compile(r" \s*\S*(?:[^\S ]\s*\S*)*")


@dataclass(frozen=True)
class Files:
    """The content of the two tokenizer files, as sent to the tasks."""

    a: bytes
    b: bytes

    @staticmethod
    def read(folder: str = FOLDER, a: str = FILE_A, b: str = FILE_B) -> Files:
        with open(f"{folder}/{a}", "rb") as first, open(f"{folder}/{b}", "rb") as second:
            return Files(first.read(), second.read())


def _byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in byte-level vocabularies: itself, or the next from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokens:
    """Both tokenizers: ids of texts, and the bytes of ids."""

    def __init__(self, files: Files) -> None:
        self.a = Tokenizer.from_str(files.a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        sign = _byte_signs()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(sign[c] for c in token) if all(c in sign for c in token) else token.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int32)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int32)
        self.by_unit = self._splits(json.loads(files.a))

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE, " ").encode()

    def _splits(self, a: dict) -> bool:
        """Whether a token always starts at a space after another sign, whatever stands before."""
        before = a.get("pre_tokenizer") or {}
        by_words = before.get("type") == "ByteLevel" and before.get("use_regex", True)
        inner = re.compile(f"[^{SPACE}]{SPACE}")
        pieces = (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        return by_words and a.get("normalizer") is None and not any(inner.search(p) for p in pieces)

    def units(self, text: str) -> list[str]:
        """The text with a space in front, in pieces that are encoded each on its own."""
        return _UNIT.findall(" " + text) if self.by_unit else [" " + text]

    def encode(self, units: Sequence[str]) -> list[Run]:
        """Runs of units that make up ``units``, in another order.

        Units are independent, so the first tokenizer takes many as one text; the halves of a run whose
        tokens do not join to it are tried again, down to the unit at fault. A unit that ends in white
        space is a run of its own.
        """
        alone = [u for u in units if not self.by_unit or u[-1].isspace()]
        joint = [u for u in units if self.by_unit and not u[-1].isspace()]
        return [r for run in ([joint] if joint else []) + [[u] for u in alone] for r in self._runs(run)]

    def _runs(self, units: list[str]) -> list[Run]:
        data = "".join(units).encode()
        ends = np.cumsum([len(u.encode()) for u in units])
        a = np.array(self.a.encode("".join(units), add_special_tokens=False).ids, np.int32)
        # The second tokenizer puts the space in front itself, but none before nothing.
        space = [self.b.piece_to_id(SPACE)]
        lists = [space if u == " " else ids for u, ids in zip(units, self.b.encode([u[1:] for u in units], num_threads=1))]
        b = np.array(list(chain.from_iterable(lists)), np.int32)
        last_a, last_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        at_a, at_b = np.searchsorted(last_a, ends), np.searchsorted(last_b, ends)
        if self._join(a, self.bytes_a, data) and self._join(b, self.bytes_b, data):
            if (last_a[at_a] == ends).all() and (last_b[at_b] == ends).all():
                sizes = [np.diff(at, prepend=-1).astype(np.int32) for at in (at_a, at_b)]
                return [Run(units, a, sizes[0], b, sizes[1], True)]
        if len(units) == 1:
            none, one = np.zeros(0, np.int32), np.zeros(1, np.int32)
            return [Run(units, none, one, none, one, False)]
        half = len(units) // 2
        return self._runs(units[:half]) + self._runs(units[half:])

    @staticmethod
    def _join(ids: np.ndarray, entries: list[bytes], data: bytes) -> bool:
        return b"".join(map(entries.__getitem__, ids.tolist())) == data


@dataclass(frozen=True)
class Run:
    """Units encoded together: the ids of both sides, how many each unit has, and if they join to it."""

    units: list[str]
    a: np.ndarray
    sizes_a: np.ndarray
    b: np.ndarray
    sizes_b: np.ndarray
    ok: bool


class Lists:
    """Many lists of ids in one array."""

    def __init__(self) -> None:
        self.flat, self.starts, self.sizes = (np.zeros(0, np.int32) for _ in range(3))

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        starts = len(self.flat) + np.cumsum(sizes, dtype=np.int32) - sizes
        self.starts, self.sizes = np.concatenate((self.starts, starts)), np.concatenate((self.sizes, sizes))
        self.flat = np.concatenate((self.flat, flat))

    def take(self, which: np.ndarray) -> np.ndarray:
        sizes = self.sizes[which]
        first = self.starts[which] - (np.cumsum(sizes, dtype=np.int32) - sizes)
        return self.flat[np.repeat(first, sizes) + np.arange(int(sizes.sum()), dtype=np.int32)]


class Units(dict):
    """Numbers of units; a new one gets the next number and is encoded with the others of its chunk."""

    def __init__(self, tokens: Tokens) -> None:
        super().__init__()
        self.tokens = tokens
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.a, self.b, self.ok, self.signs = Lists(), Lists(), np.zeros(0, bool), 0

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        self.new.append(unit)
        return number

    def _encode_new(self) -> np.ndarray:
        """Encode the new units; the number of each, in the order of their first numbers.

        Runs hold them in an order of their own, and the lists of ids follow the runs.
        """
        runs, first = self.tokens.encode(self.new), len(self) - len(self.new)
        for run in runs:
            self.a.add(run.a, run.sizes_a)
            self.b.add(run.b, run.sizes_b)
            self.ok = np.concatenate((self.ok, np.full(len(run.units), run.ok)))
        order = [u for run in runs for u in run.units]
        self.signs += sum(map(len, order))
        self.update(zip(order, range(first, len(self))))
        moved = np.array(list(map(self.__getitem__, self.new)), np.int32)
        self.new = []
        return moved

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides, and where each text's ids start and end in them."""
        if self.signs > KEPT_SIGNS:
            self._empty()
        listed, sizes = [], []
        for text in texts:
            before = len(listed)
            if text:
                listed += map(self.__getitem__, self.tokens.units(text))
            sizes.append(len(listed) - before)
        every = np.array(listed, np.int32)
        if self.new:
            first = len(self) - len(self.new)
            moved, fresh = self._encode_new(), every >= first
            every[fresh] = moved[every[fresh] - first]
        ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        wrong = np.flatnonzero(~self.ok[every])
        if len(wrong):
            kept = np.ones(len(sizes), bool)
            kept[np.searchsorted(ends, wrong, side="right") - 1] = False
            every = every[np.repeat(kept, sizes)]
            ends = np.concatenate(([0], np.cumsum(np.where(kept, sizes, 0), dtype=np.int64)))
        of_text = lambda lists: np.concatenate(([0], np.cumsum(lists.sizes[every], dtype=np.int64)))[ends]
        return self.a.take(every), self.b.take(every), of_text(self.a), of_text(self.b)


def shared_cuts(
    ends_a: np.ndarray, ends_b: np.ndarray, borders_a: np.ndarray, borders_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """First token of each group on both sides, in order; borders are those of the texts."""
    lo_a, hi_a, lo_b, hi_b = borders_a[:-1], borders_a[1:], borders_b[:-1], borders_b[1:]
    some = hi_a > lo_a
    lo_a, hi_a, lo_b, hi_b = lo_a[some], hi_a[some], lo_b[some], hi_b[some]
    leaves_a, leaves_b = [lo_a[:0]], [lo_b[:0]]
    while len(lo_a):
        at, other = _nearest(ends_a, ends_b, lo_a, hi_a, lo_b, hi_b)
        leaf, cut = at < 0, at >= 0
        leaves_a.append(lo_a[leaf])
        leaves_b.append(lo_b[leaf])
        at, other = at[cut] + 1, other[cut] + 1
        lo_a, hi_a = np.concatenate((lo_a[cut], at)), np.concatenate((at, hi_a[cut]))
        lo_b, hi_b = np.concatenate((lo_b[cut], other)), np.concatenate((other, hi_b[cut]))
    starts_a, starts_b = np.concatenate(leaves_a), np.concatenate(leaves_b)
    order = np.argsort(starts_a)
    return starts_a[order], starts_b[order]


def _nearest(
    ends_a: np.ndarray, ends_b: np.ndarray, lo_a: np.ndarray, hi_a: np.ndarray, lo_b: np.ndarray, hi_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Per interval the inner shared cut nearest to its middle, as the last tokens before it; -1 for none."""
    at, other = np.full(len(lo_a), -1, np.int64), np.full(len(lo_a), -1, np.int64)
    rest = np.flatnonzero((hi_a - lo_a > 1) & (hi_b - lo_b > 1))
    low, high = lo_a[rest], hi_a[rest] - 2
    middle = (low + high) >> 1
    for away in range(NEAR):
        for place in (middle,) if away == 0 else (-away, away):
            place = place if away == 0 else middle + place
            inside = (place >= low) & (place <= high)
            ends = ends_a[np.where(inside, place, middle)]
            found = np.searchsorted(ends_b, ends)
            hit = inside & (ends_b[found] == ends)
            at[rest[hit]], other[rest[hit]] = place[hit], found[hit]
            rest, low, high, middle = rest[~hit], low[~hit], high[~hit], middle[~hit]
        more = (middle - away > low) | (middle + away < high)
        rest, low, high, middle = rest[more], low[more], high[more], middle[more]
    for i, a, b, m in zip(rest.tolist(), low.tolist(), high.tolist(), middle.tolist()):
        found = np.searchsorted(ends_b, ends_a[a : b + 1])
        hits = np.flatnonzero(ends_b[found] == ends_a[a : b + 1])
        if len(hits):
            best = hits[np.argmin(np.abs(hits + (a - m)))]
            at[i], other[i] = a + best, found[best]
    return at, other


@dataclass(frozen=True)
class Aligned:
    """Texts aligned together: ids of both sides, groups by their first tokens, and each text's borders."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    text_a: np.ndarray
    text_b: np.ndarray

    @property
    def text_groups(self) -> np.ndarray:
        return np.searchsorted(self.group_a, self.text_a)

    @property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each group on both sides."""
        return np.diff(self.group_a, append=len(self.a)), np.diff(self.group_b, append=len(self.b))

    def notations(self) -> list[bytes]:
        """Per text its groups in decimal ids, as ``a1,a2|b1;a3|b2``."""
        if not len(self.a):
            return [b""] * (len(self.text_a) - 1)
        size_a, size_b = self.sizes
        after_a, after_b = self.group_a + size_a, self.group_b + size_b
        # A token stands behind all tokens of earlier groups and, on the second side, of its own group.
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + np.repeat(self.group_b, size_a)] = self.a
        codes[np.arange(len(self.b)) + np.repeat(after_a, size_b)] = self.b
        signs = np.zeros(len(codes), np.int8)
        signs[after_a - 1 + self.group_b] = 1
        signs[after_b - 1 + after_a] = 2
        parts = _notation()
        data = parts[codes + signs * np.int64(len(parts) // 3)].tobytes()
        at = (parts.itemsize * (self.text_a + self.text_b)).tolist()
        return [data[x:y].translate(None, b"\0")[:-1] for x, y in zip(at[:-1], at[1:])]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct linked pairs by text and pair: text, id, id, and the number of links."""
        size_a, size_b = self.sizes
        text = np.searchsorted(self.text_groups, np.arange(len(size_a)), side="right") - 1
        wide = size_a.astype(np.int64) * size_b > WIDE
        parts = [self._few(~wide, text, size_a, size_b)]
        for g in np.flatnonzero(wide).tolist():
            x, n = np.unique(self.a[self.group_a[g] : self.group_a[g] + size_a[g]], return_counts=True)
            y, m = np.unique(self.b[self.group_b[g] : self.group_b[g] + size_b[g]], return_counts=True)
            parts.append(
                (np.full(len(x) * len(y), text[g]), np.repeat(x, len(y)), np.tile(y, len(x)), np.outer(n, m).ravel())
            )
        of, x, y, n = (np.concatenate(c) for c in zip(*parts))
        place = (of.astype(np.int64) << 40) | (x.astype(np.int64) << 20) | y
        if len(parts) == 1:
            place.sort()
            first = np.flatnonzero(np.diff(place, prepend=-1))
            times = np.diff(first, append=len(place))
        else:
            place, at = np.unique(place, return_inverse=True)
            first, times = np.arange(len(place)), np.zeros(len(place), np.int64)
            np.add.at(times, at, n)
        place = place[first]
        return place >> 40, (place >> 20) & 0xFFFFF, place & 0xFFFFF, times

    def _few(
        self, chosen: np.ndarray, text: np.ndarray, size_a: np.ndarray, size_b: np.ndarray
    ) -> tuple[np.ndarray, ...]:
        """All links of the ``chosen`` groups, one by one."""
        of = np.repeat(np.arange(len(size_a)), size_a)
        token = np.flatnonzero(chosen[of])
        of = of[token]
        each = size_b[of]
        total = int(each.sum())
        inside = np.arange(total) - np.repeat(np.cumsum(each) - each, each)
        other = self.b[np.repeat(self.group_b[of], each) + inside]
        return np.repeat(text[of], each), np.repeat(self.a[token], each), other, np.ones(total, np.int64)


@cache
def _notation(ids: int = 1 << 17) -> np.ndarray:
    """Decimal numbers before a comma, then before a bar, then before a semicolon."""
    return np.array([f"{i}{sign}" for sign in ",|;" for i in range(ids)], "S8")


def align(texts: Sequence[str], units: Units) -> Aligned:
    """Align texts side by side, as one run of tokens with borders."""
    a, b, text_a, text_b = units.encode(texts)
    # A text has less than 2**31 bytes, and so has a chunk.
    ends_a = np.cumsum(units.tokens.size_a[a], dtype=np.int32)
    ends_b = np.cumsum(units.tokens.size_b[b], dtype=np.int32)
    group_a, group_b = shared_cuts(ends_a, ends_b, text_a, text_b)
    return Aligned(a, b, group_a, group_b, text_a, text_b)


_WORKER: dict[Files, Units] = {}


def _units(files: Files) -> Units:
    """The tokenizers of this worker, with the units it has met so far."""
    if files not in _WORKER:
        _WORKER.clear()
        _WORKER[files] = Units(Tokens(files))
    return _WORKER[files]


def _chunks(texts: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK`` signs; a longer text is one of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > CHUNK:
            yield start, i
            start = i
            size = 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def _text(data: bytes | None) -> str:
    try:
        return (data or b"").decode()
    except UnicodeDecodeError:
        return ""


def _lists(values: np.ndarray, borders: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(values, kind))


def _spans(chunk: Aligned) -> list[pa.Array]:
    """Per text: ids of both sides, and per group its first token on each side."""
    of = chunk.text_groups
    own = np.diff(of)
    return [
        _lists(chunk.a, chunk.text_a, pa.int32()),
        _lists(chunk.b, chunk.text_b, pa.int32()),
        _lists(chunk.group_a - np.repeat(chunk.text_a[:-1], own), of, pa.int32()),
        _lists(chunk.group_b - np.repeat(chunk.text_b[:-1], own), of, pa.int32()),
    ]


_SPANS = "doc_id bigint, a array<int>, b array<int>, group_a array<int>, group_b array<int>"


def _digests(chunk: Aligned) -> list[pa.Array]:
    """Per text: counts, the digest of the groups, and its distinct linked pairs with their links."""
    of, tokens = chunk.text_groups, np.diff(chunk.text_a)
    size_a, size_b = chunk.sizes
    links = np.concatenate(([0], np.cumsum(size_a.astype(np.int64) * size_b)))
    text, a, b, times = chunk.pairs()
    borders = np.searchsorted(text, np.arange(len(tokens) + 1))
    notes = [hashlib.sha256(n).hexdigest() if n else "" for n in chunk.notations()]
    numbers = (tokens, np.diff(chunk.text_b), np.diff(of), np.diff(links[of]))
    return [
        *(pa.array(n, pa.int64()) for n in numbers),
        pa.array(notes, pa.string()),
        _lists((a << 32) | b, borders, pa.int64()),
        _lists(times, borders, pa.int64()),
    ]


_DIGESTS = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "pairs array<bigint>, times array<bigint>"
)


def _aligning(files: Broadcast, columns, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        units = _units(files.value)
        for batch in batches:
            texts = [_text(data) for data in batch.column("_data").to_pylist()]
            ids = batch.column("doc_id")
            for i, j in _chunks(texts):
                found = columns(align(texts[i:j], units))
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), *found], names)

    return run


def _over(docs: DataFrame, files: Files, columns, schema: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(files)
    names = [part.split()[0] for part in schema.split(", ")]
    return text_bytes(docs).mapInArrow(_aligning(sent, columns, names), schema)


def alignments(docs: DataFrame, files: Files | None = None) -> DataFrame:
    """Per row the ids of both sides (``a``, ``b``) and each group's first token in them."""
    return _over(docs, files or Files.read(), _spans, _SPANS)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n, best)``: documents that hold a linked pair, and whether no pair of its first id has more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = written(counts, "pair-counts")
    first = F.shiftright("pair", 32)
    most = counts.groupBy(first.alias("_a")).agg(F.max("n").alias("_most"))
    marked = counts.withColumn("_of", first).join(most, F.col("_of") == F.col("_a"))
    return written(marked.select("pair", "n", (F.col("n") == F.col("_most")).alias("best")), "pairs")


def head_limit(counts: DataFrame, head: int = HEAD) -> int | None:
    """The lowest band of counts such that all pairs in it and above are ``head`` at most."""
    bands = counts.groupBy(_band().alias("band")).agg(F.count("*").alias("pairs")).collect()
    held, least = 0, None
    for row in sorted(bands, key=lambda r: -r["band"]):
        held += row["pairs"]
        if held > head:
            break
        least = row["band"]
    return least


def _band():
    return F.floor(F.log2("n") * BANDS).cast("int")


_SCORED = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "n_best bigint, count_sum bigint, rest array<struct<pair:bigint, times:bigint>>"
)


def _scoring(head: Broadcast):
    """Look up the pairs of a document in the head; what is not there is left to the join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = head.value
        for batch in batches:
            lists, links = batch.column("pairs"), batch.column("times")
            pairs = lists.flatten().to_numpy().astype(np.int64)
            times = links.flatten().to_numpy().astype(np.int64)
            borders = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            hits = at[known]
            sums = np.zeros((2, len(pairs) + 1), np.int64)
            sums[0, 1:][known], sums[1, 1:][known] = times[known] * best[hits], times[known] * n[hits]
            sums = np.cumsum(sums, axis=1)[:, borders]
            rest = np.concatenate(([0], np.cumsum(~known)))[borders]
            others = pa.StructArray.from_arrays([pa.array(pairs[~known]), pa.array(times[~known])], ["pair", "times"])
            columns = [batch.column(i) for i in range(7)]
            columns += [pa.array(x) for x in np.diff(sums)]
            columns.append(pa.ListArray.from_arrays(pa.array(rest, pa.int32()), others))
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in _SCORED.split(", ")[:10]])

    return run


def digests(docs: DataFrame, files: Files | None = None, head: int = HEAD) -> DataFrame:
    """Per row the counts of its alignment and links, with the corpus-wide counts of its pairs.

    Texts are read once. What is written is narrow: a document's distinct pairs. Pairs outside the head
    are rare by definition, so no key of their join is hot.
    """
    spark = docs.sparkSession
    aligned = _over(docs, files or Files.read(), _digests, _DIGESTS)
    aligned = written(aligned.select(F.monotonically_increasing_id().alias("row"), "*"), "aligned")
    counts = pair_counts(aligned)
    least = head_limit(counts, head)
    inside = _band() >= least if least is not None else F.lit(False)
    table = counts.filter(inside).toArrow()
    order = np.argsort(table["pair"].to_numpy())
    known = spark.sparkContext.broadcast(tuple(table[c].to_numpy()[order] for c in ("pair", "n", "best")))
    scored = written(aligned.mapInArrow(_scoring(known), _SCORED), "scored")
    rare = scored.select("row", F.inline("rest")).join(counts.filter(~inside), "pair")
    more = rare.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
        F.sum(F.col("times") * F.col("n")).alias("_sum"),
    )
    out = scored.drop("rest").join(more.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left")
    both = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", both("n_best", "_best"), both("count_sum", "_sum"), "groups_sha256"
    )
