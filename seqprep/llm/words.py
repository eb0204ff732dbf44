"""Words of texts as 64-bit hashes, many texts at a time.

A text is cut at its gap bytes. A word's hash is a polynomial over its bytes modulo 2**64, taken
from prefix sums over the whole buffer, and then mixed. Equal words have equal hashes; different
ones collide with a probability of about 2**-60 a pair. Buffers stay near ``CHUNK`` bytes however
long a text is; only a single word longer than that makes one larger.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C13
SEED = 0x5851F42D4C957F2D

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

#: Gap bytes of words split at white space, and of words of letters, digits and non-ASCII signs.
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
PUNCTUATION = np.array([b < 0x30 or 0x3A <= b < 0x61 or 0x7B <= b < 0x80 for b in range(256)])

_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, kept for the process."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK + 1)
        inverse = pow(BASE, -1, 1 << 64)
        for factor in (BASE, inverse):
            power = np.full(size, factor, np.uint64)
            power[0] = 1
            _POWERS.append(np.cumprod(power, dtype=np.uint64))
        del _POWERS[:-2]
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash(buffer: np.ndarray, gaps: np.ndarray, endings: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of a buffer; with ``endings`` its last bits name the word's ending."""
    n = len(buffer)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = ~gaps[buffer]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    power, inverse = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    if endings:
        last = buffer[ends - 1].astype(np.uint64)
        before = np.where(ends - starts > 1, buffer[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
        code = mix((last << np.uint64(8)) | before) % np.uint64(endings)
        hashes = (hashes & ~np.uint64(endings - 1)) | code
    return hashes, starts


def _long(data: bytes, gaps: np.ndarray, endings: int = 0) -> np.ndarray:
    """Word hashes of one long text, in pieces that end at gaps."""
    buffer, out, at = np.frombuffer(data, np.uint8), [], 0
    while at < len(buffer):
        end = min(at + CHUNK, len(buffer))
        while end < len(buffer) and not gaps[buffer[end]]:
            found = np.flatnonzero(gaps[buffer[end : end + CHUNK]])
            end = end + int(found[0]) if len(found) else min(end + CHUNK, len(buffer))
        out.append(_hash(buffer[at:end], gaps, endings)[0])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def hashed(
    texts: Sequence[bytes | None], gaps: np.ndarray = SPACES, lower: bool = True, endings: int = 0
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Groups of texts: index of the first, all word hashes, and each text's borders in them.

    With ``endings``, a power of two, a hash's value modulo it is the bucket of the word's last two bytes.
    """
    at = 0
    while at < len(texts):
        first, size, group = at, 0, []
        while at < len(texts) and (not group or size + len(texts[at] or b"") <= CHUNK):
            group.append(texts[at] or b"")
            size += len(group[-1]) + 1
            at += 1
        data = b"\n".join(group)
        data = data.translate(LOWER) if lower else data
        if len(group) == 1:
            words = _long(data, gaps, endings)
            yield first, words, np.array([0, len(words)])
            continue
        words, starts = _hash(np.frombuffer(data, np.uint8), gaps, endings)
        offsets = np.cumsum([0] + [len(x) + 1 for x in group])
        yield first, words, np.searchsorted(starts, offsets)


def word_lists(
    texts: Sequence[bytes | None], gaps: np.ndarray = SPACES, lower: bool = True
) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order."""
    for _, words, borders in hashed(texts, gaps, lower):
        for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
            yield words[a:b]


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; empty for a shorter text."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, np.uint64(SEED + n), np.uint64)
    for j in range(n):
        factor = (BASE * (2 * j + 1) + (j << 33)) % (1 << 64) | 1
        total += words[j : j + count] * np.uint64(factor)
    return mix(total)


def minimisers(values: np.ndarray, window: int) -> np.ndarray:
    """Positions that hold the first smallest value of some run of ``window`` values."""
    if len(values) == 0:
        return np.zeros(0, np.int64)
    width = min(window, len(values))
    view = np.lib.stride_tricks.sliding_window_view(values, width)
    at = view.argmin(axis=1) + np.arange(len(view))
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return values.astype(np.uint64).view(np.int64)
