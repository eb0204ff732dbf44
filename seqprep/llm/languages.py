"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of ``DIM`` signs, made from its code point. A trigram's vector
binds (multiplies) its letters' vectors, the first permuted twice and the second once. A text's
profile bundles (adds) the vectors of all its trigrams, and a language's prototype bundles the
profiles of its texts. The language whose prototype has the largest cosine with a text's profile is
predicted, and that cosine is the score.

Prototypes are integers, summed per task and then by Spark, so they do not depend on placement. The
driver receives ``DIM`` numbers per language; more than ``MAX_LANGUAGES`` learned values are an error.

Defined results: ``und`` with score 0 for a NULL text, a text without letters, and every text if
nothing was learned; ties go to the first language by code point; repeated rows are learned and
predicted each. A row without ``doc_id`` is learned from. An empty table gives no rows. Only
``doc_id``, ``text`` and, for learning, ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.llm.frames import free, id_remainder
from seqprep.llm.words import mix

DIM = 1024
FOLDS = 4
HELD_OUT = 2
MAX_LANGUAGES = 4096
UNKNOWN = "und"
#: Rejected by the pipeline below this cosine, if there are letters enough for a text of a learned
#: language to lie far above it.
MIN_SCORE = 0.05
MIN_LETTERS = 64
#: Letters handled at once, texts of one matrix product, and trigram vectors kept by a task.
CHUNK = 1 << 20
TEXTS = 64
KEPT_VECTORS = 1 << 15

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Lower-case code point of each letter, 0 for all else."""
    if not _LETTERS:
        table = np.zeros(0x110000, np.uint32)
        for point in range(0x110000):
            if (sign := chr(point)).isalpha():
                low = sign.lower()
                table[point] = ord(low) if len(low) == 1 else point
        _LETTERS.append(table)
    return _LETTERS[0]


def trigrams(text: bytes) -> np.ndarray:
    """Codes of all runs of three letters, runs of other signs counting as one gap."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    letters = _letters()[points]
    if not letters.any():
        return np.zeros(0, np.uint64)
    padded = np.concatenate((np.zeros(1, np.uint32), letters, np.zeros(1, np.uint32)))
    keep = np.concatenate(([True], (padded[1:] != 0) | (padded[:-1] != 0)))
    padded = padded[keep].astype(np.uint64)
    codes = (padded[:-2] << np.uint64(42)) | (padded[1:-1] << np.uint64(21)) | padded[2:]
    return codes


def _signs(points: np.ndarray) -> np.ndarray:
    """A row of ``DIM`` signs per letter."""
    seeds = mix(points.astype(np.uint64) + np.uint64(0x1F123BB5))[:, None]
    bits = mix(seeds + np.arange(DIM // 64, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15))
    rows = np.unpackbits(bits.view(np.uint8).reshape(len(points), -1), axis=1)
    return (rows.astype(np.int8) << 1) - 1


def bound(codes: np.ndarray) -> np.ndarray:
    """The vector of each trigram."""
    parts = [(codes >> np.uint64(shift)) & np.uint64(0x1FFFFF) for shift in (42, 21, 0)]
    points, which = np.unique(np.concatenate(parts), return_inverse=True)
    signs, (a, b, c) = _signs(points), which.reshape(3, -1)
    return np.roll(signs, 2, axis=1)[a] * np.roll(signs, 1, axis=1)[b] * signs[c]


class Vectors:
    """Trigram vectors of a task, made when first met."""

    def __init__(self) -> None:
        self.codes = np.zeros(0, np.uint64)
        self.rows = np.zeros((0, DIM), np.int8)

    def of(self, codes: np.ndarray) -> np.ndarray:
        """Rows of sorted distinct ``codes``."""
        new = codes[~np.isin(codes, self.codes, assume_unique=True)]
        if len(self.codes) + len(new) > KEPT_VECTORS:
            self.codes, self.rows, new = codes[:0], self.rows[:0], codes
        if len(new):
            merged = np.concatenate((self.codes, new))
            order = np.argsort(merged, kind="stable")
            self.codes, self.rows = merged[order], np.concatenate((self.rows, bound(new)))[order]
        return self.rows[np.searchsorted(self.codes, codes)]

    def bundle(self, counts: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Profiles of texts given as distinct trigrams and their counts."""
        codes = np.unique(np.concatenate([c for c, _ in counts]))
        out = np.zeros((len(counts), DIM))
        for at in range(0, len(codes), KEPT_VECTORS // 4):
            part = codes[at : at + KEPT_VECTORS // 4]
            table = np.zeros((len(counts), len(part)), np.float32)
            for i, (own, n) in enumerate(counts):
                low, high = np.searchsorted(own, part[0]), np.searchsorted(own, part[-1], "right")
                table[i, np.searchsorted(part, own[low:high])] = n[low:high]
            out += table @ self.of(part).astype(np.float32)
        return out


def _counted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(trigrams(text), return_counts=True)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One integer vector per language and task."""
    vectors, sums = Vectors(), {}

    def add(lang: str, held: list[np.ndarray]) -> None:
        counts = np.unique(np.concatenate(held), return_counts=True)
        if len(counts[0]):
            profile = np.rint(vectors.bundle([counts])[0]).astype(np.int64)
            sums[lang] = sums.get(lang, 0) + profile

    for batch in batches:
        held: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("_data").to_pylist()):
            codes = trigrams(text or b"")
            held.setdefault(lang, []).append(codes)
            size[lang] = size.get(lang, 0) + len(codes)
            if size[lang] > CHUNK:
                add(lang, held.pop(lang))
                size[lang] = 0
        for lang, codes in held.items():
            add(lang, codes)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.int64()))],
        ["lang", "profile"],
    )


def learn(docs: DataFrame) -> dict[str, np.ndarray]:
    """The prototype of each learned language."""
    training = docs.filter("lang is not null").filter(F.coalesce(id_remainder(FOLDS) != HELD_OUT, F.lit(True)))
    rows = training.select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").cast("binary").alias("_data")
    )
    sums = (
        rows.mapInArrow(_learn, "lang string, profile array<bigint>")
        .select("lang", F.posexplode("profile").alias("at", "n"))
        .groupBy("lang", "at")
        .agg(F.sum("n").alias("n"))
        .limit(MAX_LANGUAGES * DIM + 1)
        .toPandas()
    )
    if len(sums) > MAX_LANGUAGES * DIM:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang")
    table = sums.pivot(index="lang", columns="at", values="n").sort_index()
    return {lang: row.to_numpy(np.float64) for lang, row in table.iterrows()}


def predictor(prototypes: dict[str, np.ndarray]) -> Callable[[Sequence[bytes | None]], tuple[list, list]]:
    """A function from texts to languages and scores."""
    names = sorted(prototypes)
    table = np.array([prototypes[n] / max(np.linalg.norm(prototypes[n]), 1e-300) for n in names])
    vectors: list[Vectors] = []

    def predict(texts: Sequence[bytes | None]) -> tuple[list[str], list[float]]:
        if not vectors:
            vectors.append(Vectors())
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        for at in range(0, len(texts), TEXTS):
            counts = [_counted(t or b"") for t in texts[at : at + TEXTS]]
            some = [i for i, (codes, _) in enumerate(counts) if len(codes)]
            if not some or not names:
                continue
            profiles = vectors[0].bundle([counts[i] for i in some])
            lengths = np.linalg.norm(profiles, axis=1)
            cosines = (profiles @ table.T) / np.maximum(lengths, 1e-300)[:, None]
            for i, best, row in zip(some, cosines.argmax(axis=1).tolist(), cosines):
                langs[at + i], scores[at + i] = names[best], float(min(max(row[best], 0.0), 1.0))
        return langs, scores

    return predict


def prediction(docs: DataFrame, text: Column | None = None, learned: dict[str, np.ndarray] | None = None) -> Column:
    """A struct of ``lang`` and ``score`` for a text column, learned from ``docs``."""
    predict = predictor(learn(docs) if learned is None else learned)

    @F.pandas_udf("lang string, score double")
    def run(data: pd.Series) -> pd.DataFrame:
        langs, scores = predict(data.tolist())
        return pd.DataFrame({"lang": langs, "score": scores})

    text = F.col("text") if text is None else text
    return run(text.cast("string").cast("binary"))


def identify(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``held_out``, ``lang_pred`` and ``score``."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(id_remainder(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        prediction(docs).alias("_found"),
    )
    return rows.select(
        "doc_id", "held_out", F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score")
    )


def drop_unidentified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` whose language is known; columns as they were.

    A text without a letter goes, and one of ``MIN_LETTERS`` or more whose score is below
    ``min_score``; a shorter text says too little to be rejected. Where no row names a language there
    is nothing to judge by, and all rows stay.
    """
    learned = learn(docs)
    if not learned:
        return docs
    (name,) = free(docs, "_found")
    found = docs.withColumn(name, prediction(docs, learned=learned))
    short = F.regexp_count(F.col("text").cast("string"), F.lit(r"\p{L}")) < MIN_LETTERS
    sure = (F.col(name)["lang"] != UNKNOWN) & ((F.col(name)["score"] >= min_score) | short)
    return found.filter(sure).select(*[docs[c] for c in docs.columns])
