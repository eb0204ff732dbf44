"""Log-bilinear language model by noise-contrastive estimation, and scores of all texts.

The model predicts the vector of the next word from the vectors of the two words before it, each
through its own matrix, and scores a word by its product with the prediction plus a bias. The model is
factored by classes: a frequent training token is a class of its own, all other words, also those of no
training text, are ``ENDINGS`` classes by their last two bytes, inside which a word has its smoothed unigram
share; so a text's probability is normalised over all words, and a rare word tells and learns by its ending.
Normalisers come from matrix products over batches of distinct contexts.

Tokens are counted over the whole training corpus and joined with the texts' rare tokens; only the
frequent (``HEAD`` at most) are broadcast. Each task trains on all of its training rows from one
common start, and parameters are averaged by tokens: parameter mixing, exact sums in Spark.

Defined results: a NULL or empty text is its end token alone; without training rows all words share
one class; a row without ``doc_id`` is learned from and not held out; repeated rows count and return
each. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.llm.frames import id_remainder, text_bytes, written
from seqprep.llm.words import hashed, signed

FOLDS = 5
HELD_OUT = 1
#: Classes of single tokens at most, the fewest training occurrences of one, and classes by ending.
TOKENS = 512
LEAST = 100
ENDINGS = 512
DIM = 16
NOISE = 64
BATCH = 4096
RATE = 0.05
#: Tokens whose counts are broadcast, 16 bytes each; bins of counts to find them, per doubling.
HEAD = 1 << 18
BINS = 16
#: Fraction bits of averaged parameters.
FRACTION = 24
END = np.uint64(0x0E4D)
SMOOTH = 0.5


@dataclass(frozen=True)
class Counts:
    """The frequent tokens, sorted by hash, with counts and classes; totals of all tokens."""

    keys: np.ndarray
    n: np.ndarray
    classes: np.ndarray
    tokens: int
    types: int
    shares: np.ndarray  # of the classes; the first ones are endings
    inside: np.ndarray  # log10 of the smoothed occurrences of each ending

    def place(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def classed(self, keys: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Class of each key, placed at ``at``: its own, or that of its ending."""
        endings = (keys % np.uint64(ENDINGS)).astype(np.int32)
        return np.where(at >= 0, self.classes[np.maximum(at, 0)], endings) if len(self.keys) else endings


def documents(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of texts as token hashes, each text closed by its end, and the texts' borders."""
    for _, words, borders in hashed(texts, endings=ENDINGS):
        yield np.insert(words, borders[1:], END), borders + np.arange(len(borders))


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.unique(t, return_counts=True) for t, _ in documents(batch.column("_data").to_pylist())]
        if not found:
            continue
        keys, which = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        n = np.bincount(which, np.concatenate([c for _, c in found]), len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(n)], ["key", "n"])


def training(docs: DataFrame) -> DataFrame:
    return text_bytes(docs.filter(F.coalesce(id_remainder(FOLDS) != HELD_OUT, F.lit(True)))).select("_data")


def count_tokens(docs: DataFrame) -> DataFrame:
    """``(key, n)`` of all training tokens, written down."""
    counted = training(docs).mapInArrow(_tally, "key bigint, n bigint")
    return written(counted.groupBy("key").agg(F.sum("n").alias("n")), "token_counts")


def frequent(counts: DataFrame) -> Counts:
    """Totals and the most frequent tokens: whole bins of counts while they fit ``HEAD``."""
    size = F.floor(F.log2("n") * BINS).cast("int")
    bins = counts.groupBy(size.alias("bin")).agg(F.count("*").alias("types"), F.sum("n").alias("n")).collect()
    tokens, types = sum(b["n"] for b in bins), sum(b["types"] for b in bins)
    held, least = 0, None
    for b in sorted(bins, key=lambda b: -b["bin"]):
        held += b["types"]
        if held > HEAD:
            break
        least = b["bin"]
    rows = counts.filter(size >= least if least is not None else F.lit(False)).toArrow()
    keys, n = rows["key"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    top = np.lexsort((keys, -n))[:TOKENS]
    top = top[n[top] >= LEAST]
    classes = (keys % np.uint64(ENDINGS)).astype(np.int32)
    ending = F.pmod("key", F.lit(ENDINGS)).cast("int")
    own = counts.groupBy(ending.alias("ending")).agg(F.count("*").alias("types"), F.sum("n").alias("n"))
    # A word of no training text has one share in its ending.
    masses = np.full(ENDINGS, SMOOTH)
    for row in own.collect():
        masses[row["ending"]] += row["n"] + SMOOTH * row["types"]
    np.subtract.at(masses, classes[top], n[top] + SMOOTH)
    classes[top] = np.arange(ENDINGS, ENDINGS + len(top))
    inside = np.log10(masses)
    masses = np.concatenate((masses, n[top] + SMOOTH))
    return Counts(keys, n, classes, tokens, types, masses / masses.sum(), inside)


class LogBilinear:
    """Parameters and both passes; class ``k`` of ``k`` classes is the start of a text."""

    def __init__(self, shares: np.ndarray) -> None:
        k, random = len(shares), np.random.default_rng(5)
        self.k, self.shares = k, shares
        self.shapes = [(k + 1, DIM), (k, DIM), (DIM, DIM), (DIM, DIM), (k,)]
        self.parts = [
            random.normal(0, 0.1, (k + 1, DIM)),
            np.zeros((k, DIM)),
            np.eye(DIM) * 0.5,
            np.eye(DIM),
            np.log(shares),
        ]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    def load(self, values: np.ndarray) -> LogBilinear:
        at = 0
        for i, shape in enumerate(self.shapes):
            size = math.prod(shape)
            self.parts[i] = values[at : at + size].reshape(shape)
            at += size
        return self

    def predicted(self, far: np.ndarray, near: np.ndarray) -> np.ndarray:
        words, _, first, second, _ = self.parts
        return words[far] @ first + words[near] @ second

    def normaliser(self, far: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Log of the summed scores of all classes, for each context."""
        _, outs, _, _, bias = self.parts
        scores = self.predicted(far, near).astype(np.float32) @ outs.T.astype(np.float32)
        scores += bias.astype(np.float32)
        most = scores.max(axis=1)
        scores -= most[:, None]
        return np.log(np.exp(scores, out=scores).sum(axis=1, dtype=np.float64)) + most

    def score(self, far: np.ndarray, near: np.ndarray, target: np.ndarray) -> np.ndarray:
        _, outs, _, _, bias = self.parts
        return np.einsum("ij,ij->i", self.predicted(far, near), outs[target]) + bias[target]


class Trainer:
    """Noise-contrastive steps with per-parameter rates (sums of squared gradients)."""

    def __init__(self, model: LogBilinear) -> None:
        self.model, self.random = model, np.random.default_rng(11)
        self.squares = [np.full(shape, 1e-6) for shape in model.shapes]

    def step(self, far: np.ndarray, near: np.ndarray, target: np.ndarray) -> None:
        m, n = self.model, len(target)
        words, outs, first, second, bias = m.parts
        noise = self.random.choice(m.k, NOISE, p=m.shares)
        a, b = words[far], words[near]
        guess = a @ first + b @ second
        offset = np.log(NOISE * m.shares)
        real = np.einsum("ij,ij->i", guess, outs[target]) + bias[target] - offset[target]
        fake = guess @ outs[noise].T + bias[noise] - offset[noise]
        # Share of doubt that a true word is true, and of belief that a noise word is.
        doubt = -1 / (1 + np.exp(np.clip(real, -30, 30))) / n
        belief = 1 / (1 + np.exp(np.clip(-fake, -30, 30))) / n
        to_guess = doubt[:, None] * outs[target] + belief @ outs[noise]
        grads = [np.zeros(shape) for shape in m.shapes]
        np.add.at(grads[0], far, to_guess @ first.T)
        np.add.at(grads[0], near, to_guess @ second.T)
        np.add.at(grads[1], target, doubt[:, None] * guess)
        np.add.at(grads[1], noise, belief.T @ guess)
        grads[2], grads[3] = a.T @ to_guess, b.T @ to_guess
        np.add.at(grads[4], target, doubt)
        np.add.at(grads[4], noise, belief.sum(axis=0))
        for part, grad, square in zip(m.parts, grads, self.squares):
            square += grad * grad
            part -= RATE * grad / np.sqrt(square)


def contexts(classes: np.ndarray, borders: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The classes two before and one before each token; ``start`` before a text."""
    near, far = np.roll(classes, 1), np.roll(classes, 2)
    firsts = borders[:-1]
    near[firsts] = start
    far[firsts] = start
    seconds = firsts[np.diff(borders) > 1] + 1
    far[seconds] = start
    return far, near


def _fit(counts: Counts) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LogBilinear(counts.shares)
        trainer, tokens = Trainer(model), 0
        for batch in batches:
            for keys, borders in documents(batch.column("_data").to_pylist()):
                at = counts.place(keys)
                classes = counts.classed(keys, at)
                far, near = contexts(classes, borders, model.k)
                for i in range(0, len(classes), BATCH):
                    trainer.step(far[i : i + BATCH], near[i : i + BATCH], classes[i : i + BATCH])
                tokens += len(classes)
        if tokens:
            values = np.rint(model.flat() * (1 << FRACTION)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([tokens]), pa.array([values], pa.list_(pa.int64()))], ["tokens", "values"]
            )

    return run


def fit(docs: DataFrame, counts: Counts) -> LogBilinear:
    """The averaged model. The driver receives one number per parameter."""
    model = LogBilinear(counts.shares)
    if not len(counts.keys):
        return model
    parts = training(docs).mapInArrow(_fit(counts), "tokens bigint, values array<bigint>")
    weighted = parts.select("tokens", F.posexplode("values").alias("at", "v"))
    sums = weighted.groupBy("at").agg(
        F.sum(F.col("v").cast("decimal(19,0)") * F.col("tokens")).alias("v"), F.sum("tokens").alias("tokens")
    )
    mean = F.col("v").cast("double") / F.col("tokens") / float(1 << FRACTION)
    rows = sums.select("at", mean.alias("v")).toArrow().sort_by("at")
    return model.load(rows["v"].to_numpy()) if rows.num_rows else model


_SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, "
    "rare array<struct<key:bigint, m:bigint>>"
)


def _score(counts: Counts, parameters: np.ndarray):
    """Sums over each text's tokens that need no join, and its rare tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LogBilinear(counts.shares).load(parameters)
        logs = np.log10(counts.n + SMOOTH)
        k = model.k
        known_z = np.full((k + 1) * (k + 1), np.nan)
        for batch in batches:
            columns: list[list] = [[] for _ in range(5)]
            for keys, borders in documents(batch.column("_data").to_pylist()):
                at = counts.place(keys)
                hit, safe = at >= 0, np.maximum(at, 0)
                classes = counts.classed(keys, at)
                far, near = contexts(classes, borders, k)
                context = far.astype(np.int64) * (k + 1) + near
                new = np.unique(context)
                new = new[np.isnan(known_z[new])]
                for i in range(0, len(new), BATCH):
                    part = new[i : i + BATCH]
                    known_z[part] = model.normaliser(part // (k + 1), part % (k + 1))
                score = (model.score(far, near, classes) - known_z[context]) / math.log(10)
                base = np.where(hit, logs[safe], 0.0) if len(logs) else np.zeros(len(at))
                rest = classes < ENDINGS
                inside = np.where(rest, base - counts.inside[np.minimum(classes, ENDINGS - 1)], 0.0)
                firsts = borders[:-1]
                columns[0] += np.diff(borders).tolist()
                columns[1] += np.add.reduceat(hit.astype(np.int64), firsts).tolist()
                columns[2] += np.add.reduceat(base, firsts).tolist()
                columns[3] += np.add.reduceat(score + inside, firsts).tolist()
                places = np.flatnonzero(~hit)
                cuts = np.searchsorted(places, borders)
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    own, m = np.unique(keys[places[a:b]], return_counts=True)
                    columns[4].append([{"key": x, "m": y} for x, y in zip(signed(own).tolist(), m.tolist())])
            kind = pa.list_(pa.struct([("key", pa.int64()), ("m", pa.int64())]))
            types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), kind]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out")]
                + [pa.array(c, t) for c, t in zip(columns, types)],
                ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"],
            )

    return run


def score(docs: DataFrame) -> DataFrame:
    """Per row: tokens, known tokens, and the log10 probability by unigram and by the model."""
    table = count_tokens(docs)
    counts = frequent(table)
    model = fit(docs, counts)
    held_out = F.coalesce(id_remainder(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")
    scored = text_bytes(docs, held_out).mapInArrow(_score(counts, model.flat()), _SCORED)
    scored = written(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("_row", F.explode("rare").alias("r")).select("_row", "r.key", "r.m")
    joined = rare.join(table, "key", "left").groupBy("_row").agg(
        F.sum(F.col("m") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("_more"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("m")).otherwise(0)).alias("_known"),
    )
    out = scored.drop("rare").join(joined, "_row", "left")
    more = F.coalesce("_more", F.lit(0.0))
    whole = math.log10(counts.tokens + SMOOTH * (counts.types + 1))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(counts.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
