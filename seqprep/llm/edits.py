"""Token counts that follow edits, by a segment tree of pre-tokens per document.

A byte-pair tokenizer encodes each pre-token on its own, so a text's token count is the sum over its
pre-tokens. ``TokenTree`` holds them in blocks, with the sums of lengths and counts in a binary tree
above. An edit finds its blocks through the tree, starts again at a pre-token boundary safely before
the edit, splits and encodes only until a new boundary meets an old one behind it, and updates the
sums on the way to the root.

Defined results: a NULL text counts as empty, 0 tokens; positions beyond the text's end mean its end,
negative ones its start; a NULL list of edits changes nothing, a NULL edit is skipped, NULL as text
inserts nothing; repeated rows return each, with or without ``doc_id``. An empty table gives no rows.
Only ``doc_id``, ``text`` and the edits are read.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterator, Sequence

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that belongs to the rank file.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Pre-tokens of a block; counts of pre-tokens kept by a task.
BLOCK = 64
KEPT_COUNTS = 200_000

EDITS = "array<struct<start:int, stop:int, insert:string>>"


class Counter:
    """Tokens of a pre-token, kept while there is room."""

    def __init__(self, ranks: str = RANKS, pattern: str = PATTERN) -> None:
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.kept: dict[str, int] = {}

    def count(self, token: str) -> int:
        found = self.kept.get(token)
        if found is None:
            if len(self.kept) >= KEPT_COUNTS:
                self.kept.clear()
            found = self.kept[token] = len(self.encoding.encode_ordinary(token))
        return found

    def leaves(self, text: str) -> tuple[list[int], list[int]]:
        """Length and token count of each pre-token of a whole text."""
        tokens = self.pattern.findall(text)
        kept = self.kept
        counts = [kept.get(t, -1) for t in tokens]
        if -1 in counts:
            counts = [self.count(t) if n < 0 else n for t, n in zip(tokens, counts)]
        return list(map(len, tokens)), counts


class TokenTree:
    """A document's pre-tokens under edits. ``text`` is the current text, ``tokens`` its count."""

    def __init__(self, text: str, counter: Counter) -> None:
        self.text, self.counter, self.encoded = text, counter, 0
        self._build(*counter.leaves(text))

    def _build(self, lengths: list[int], counts: list[int]) -> None:
        size = max(1, -(-len(lengths) // BLOCK))
        self.lengths = [lengths[i * BLOCK : (i + 1) * BLOCK] for i in range(size)]
        self.counts = [counts[i * BLOCK : (i + 1) * BLOCK] for i in range(size)]
        self.width = 1 << (size - 1).bit_length()
        self.chars, self.sums = [0] * (2 * self.width), [0] * (2 * self.width)
        for i in range(size):
            self.chars[self.width + i] = sum(self.lengths[i])
            self.sums[self.width + i] = sum(self.counts[i])
        for node in range(self.width - 1, 0, -1):
            self._add(node)

    def _add(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    @property
    def tokens(self) -> int:
        return self.sums[1]

    @property
    def pretokens(self) -> int:
        return sum(map(len, self.lengths))

    def _find(self, place: int) -> tuple[int, int]:
        """The block that holds character ``place``, and the block's start."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place - start >= self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.width, start

    def _restart(self, place: int) -> int:
        """A place that no look-ahead of an earlier pre-token passes on its way to ``place``.

        A pre-token ends where the next sign cannot continue it, or by looking past white space.
        Before the white space that touches ``place`` there is a whole other pre-token to spare.
        """
        at = max(place - 1, 0)
        while at > 0 and self.text[at].isspace():
            at -= 1
        return max(at - 2, 0)

    def edit(self, start: int, stop: int, insert: str) -> None:
        """Replace characters ``[start, stop)``."""
        size = len(self.text)
        start = min(max(start, 0), size)
        stop = min(max(stop, start), size)
        block, at = self._find(self._restart(start))
        limit = self._restart(start)
        lengths = self.lengths[block]
        first = 0
        while first < len(lengths) and at + lengths[first] <= limit:
            at += lengths[first]
            first += 1
        moved = len(insert) - (stop - start)
        self.text = self.text[:start] + insert + self.text[stop:]
        # Old boundaries from here on, one at a time, in the new text's places.
        old = self._boundaries(block, first, at)
        old_at, old_block, old_leaf = next(old)
        new_lengths, new_counts, place = [], [], at
        fresh = start + len(insert)
        while place < len(self.text):
            while old_at < stop or old_at + moved < place:
                step = next(old, None)
                if step is None:
                    break
                old_at, old_block, old_leaf = step
            if place >= fresh and old_at >= stop and old_at + moved == place:
                break
            token = self.counter.pattern.match(self.text, place)[0]
            new_lengths.append(len(token))
            new_counts.append(self.counter.count(token))
            place += len(token)
        else:
            old_block, old_leaf = len(self.lengths) - 1, len(self.lengths[-1])
        self.encoded += len(new_lengths)
        self._splice(block, first, old_block, old_leaf, new_lengths, new_counts)

    def _boundaries(self, block: int, leaf: int, at: int) -> Iterator[tuple[int, int, int]]:
        """Starts of leaves, and the end, with their block and index."""
        for b in range(block, len(self.lengths)):
            for i in range(leaf if b == block else 0, len(self.lengths[b])):
                yield at, b, i
                at += self.lengths[b][i]
        yield at, len(self.lengths) - 1, len(self.lengths[-1])

    def _splice(self, block: int, first: int, last: int, end: int, lengths: list[int], counts: list[int]) -> None:
        """Replace the leaves from ``(block, first)`` up to ``(last, end)``."""
        self.lengths[block] = self.lengths[block][:first] + lengths + self.lengths[last][end:]
        self.counts[block] = self.counts[block][:first] + counts + self.counts[last][end:]
        for i in range(block + 1, last + 1):
            self.lengths[i], self.counts[i] = [], []
        if len(self.lengths[block]) > 4 * BLOCK:
            flat = itertools.chain.from_iterable
            self._build(list(flat(self.lengths)), list(flat(self.counts)))
            return
        for i in range(block, last + 1):
            node = self.width + i
            self.chars[node], self.sums[node] = sum(self.lengths[i]), sum(self.counts[i])
            node //= 2
            while node:
                self._add(node)
                node //= 2


def _follow(ranks: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks, pattern)
        for batch in batches:
            rows = []
            texts, edits = batch.column("_text").to_pylist(), batch.column("_edits").to_pylist()
            for text, changes in zip(texts, edits):
                tree = TokenTree(text or "", counter)
                before = tree.tokens
                for change in _given(changes):
                    tree.edit(*change)
                rows.append((before, tree.tokens, tree.pretokens, tree.encoded, len(tree.text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array([r[i] for r in rows], pa.int64()) for i in range(5)],
                ["doc_id", "n_tokens", "n_tokens_after", "n_pretokens_after", "n_encoded", "n_chars_after"],
            )

    return run


def _given(changes: Sequence[dict] | None) -> Iterator[tuple[int, int, str]]:
    for change in changes or []:
        if change is not None:
            start = change["start"] or 0
            yield start, start if change["stop"] is None else change["stop"], change["insert"] or ""


def count_edited(
    docs: DataFrame, edits: Column, ranks: str = RANKS, pattern: str = PATTERN
) -> DataFrame:
    """Per row the token counts before and after ``edits``, each on the text the one before left.

    ``n_encoded`` is the number of pre-tokens that the edits had to encode again.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("_text"),
        edits.cast(EDITS).alias("_edits"),
    )
    counts = "n_tokens bigint, n_tokens_after bigint, n_pretokens_after bigint, n_encoded bigint, n_chars_after bigint"
    return rows.mapInArrow(_follow(ranks, pattern), f"doc_id bigint, {counts}")
