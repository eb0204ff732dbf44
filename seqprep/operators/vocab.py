"""Corpus vocabulary, and text to ids against it."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqprep.functions.sequences import truncate
from seqprep.operators.ranges import NARROW_ROWS_PER_RANGE as RANK_ROWS
from seqprep.operators.ranges import key_ranges, range_id, with_position
from seqprep.plans.storage import written

# Fixed value: a token is a run of ASCII letters and digits, or any other single non-space sign.
TOKEN_PATTERN = r"[a-z0-9]++|[^a-z0-9\s]"

PAD, UNK, EOS = "<pad>", "<unk>", "</s>"
SPECIALS = (PAD, UNK, EOS)

# A vocabulary up to the first size travels inside the plan, up to the second as a broadcast table.
INLINE_ROWS = 32_768
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Entries that are ordered in one task, from the first ones of every task.
TOP_ROWS = 100_000

# Candidates per entry that a sketch is asked for. Fixed values of the frequent-items sketch: the share of
# its slots that it fills, and its error per slot as a multiple of the mean.
CANDIDATES = 4
SKETCH_LOAD = 0.75
SKETCH_ERROR = 3.5

# A word of more bytes is counted as its tokens.
LONG_WORD_BYTES = 32


def _tokens(lowered: Column, marks: Sequence[str]) -> Column:
    pattern = "|".join([*(re.escape(m.lower()) for m in marks), TOKEN_PATTERN])
    return F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0))


def tokens_of(text: Column, marks: Sequence[str] = ()) -> Column:
    """Lower-cased tokens of the whole text; each of ``marks`` is one token where it occurs."""
    return _tokens(F.lower(text), marks)


def count_tokens(df: DataFrame, text: str, marks: Sequence[str] = ()) -> DataFrame:
    """``(tok, n)`` over all texts.

    No token holds a space, so words are counted first and each distinct word is taken apart once;
    that is several times less pattern matching. A long word, such as a line of a script without
    spaces, is taken apart at once and counted as its tokens, so that what is exchanged stays
    short. Both counts are combined before their exchange: a token that makes up a third of the
    corpus costs one row per task.
    """
    if any(re.search(r"\s", mark) for mark in marks):
        raise ValueError("a mark must not hold a space")
    words = df.select(F.explode(F.split(F.lower(F.col(text)), r"\s+")).alias("word"))
    long = F.octet_length("word") > LONG_WORD_BYTES
    pieces = F.when(long, _tokens(F.col("word"), marks)).otherwise(F.array("word"))
    counted = words.select(F.explode(pieces).alias("word")).groupBy("word").agg(
        F.count("*").alias("n")
    )
    tokens = counted.select(F.explode(_tokens(F.col("word"), marks)).alias("tok"), "n")
    return tokens.groupBy("tok").agg(F.sum("n").alias("n"))


def build_vocab(
    df: DataFrame,
    text: str,
    size: int,
    specials: Sequence[str] = SPECIALS,
    marks: Sequence[str] = (),
    tracked: int | None = None,
) -> DataFrame:
    """``(tok, id)``: the specials, then the ``size`` most frequent tokens, ties by token.

    Up to ``TOP_ROWS`` entries each task keeps its own most frequent ones and only these are ordered
    together. A larger vocabulary is written down as counts and numbered over value ranges; ranges
    past the last entry are dropped first. With ``tracked`` the candidates come from a sketch of so
    many tokens (:func:`candidates`), and only they are counted; the result is the same.
    """
    counted = None
    if tracked is not None:
        counted = candidate_counts(df, text, size + len(specials), tracked, marks)
    if counted is None:
        counted = count_tokens(df, text, marks)
    if specials:
        counted = counted.filter(~F.col("tok").isin(*specials))
    counted = counted.select((-F.col("n")).alias("_less"), "tok")
    if size <= TOP_ROWS:
        top = counted.orderBy("_less", "tok").limit(size)
        placed = top.withColumn("_rank", F.row_number().over(Window.orderBy("_less", "tok")) - 1)
    else:
        counted = written(counted, "token_counts")
        ranges = key_ranges(counted, ["_less", "tok"], RANK_ROWS)
        needed = sum(before < size for before in ranges.offsets)
        placed = with_position(counted.filter(range_id(counted, ranges) < needed), ranges, "_rank")
    rank = F.col("_rank") + len(specials)
    ranked = placed.filter(F.col("_rank") < size).select("tok", rank.cast("bigint").alias("id"))
    if not specials:
        return ranked
    fixed = df.sparkSession.createDataFrame(
        [(tok, i) for i, tok in enumerate(specials)], "tok string, id bigint"
    )
    return fixed.unionByName(ranked)


def candidates(
    df: DataFrame, text: str, wanted: int, tracked: int, marks: Sequence[str] = ()
) -> tuple[list[str], float]:
    """Tokens that may be among the ``wanted`` most frequent, and a count that no other one exceeds.

    Each task keeps a sketch of ``tracked`` tokens (Spark's frequent-items sketch, which merges like
    Misra-Gries counters), and one sketch per task is exchanged however many distinct tokens there are.
    """
    tokens = df.select(F.explode(tokens_of(F.col(text), marks)).alias("tok"))
    kept = min(tracked, CANDIDATES * wanted)
    row = tokens.agg(
        F.expr(f"approx_top_k(tok, {kept}, {tracked})").alias("top"), F.count("*").alias("n")
    ).first()
    found = [r["item"] for r in row["top"] or []]
    # A token that is returned is estimated at its count or above. The sketch keeps back tokens whose
    # lower bound is within its error, so one that is not returned may have twice the error.
    slots = 1 << math.ceil(math.log2(max(tracked / SKETCH_LOAD, 8)))
    missed = 2 * row["n"] * SKETCH_ERROR / slots
    if len(found) == kept:
        missed = max(missed, row["top"][-1]["count"])
    return found, missed


def candidate_counts(
    df: DataFrame, text: str, wanted: int, tracked: int, marks: Sequence[str] = ()
) -> DataFrame | None:
    """Exact counts of the candidates; None if others might be among the ``wanted`` most frequent.

    That is so where many tokens are about as frequent as the last one wanted; a larger sketch helps.
    """
    if not 0 < wanted <= tracked:
        return None
    found, missed = candidates(df, text, wanted, tracked, marks)
    schema = "_tok string"
    table = df.sparkSession.createDataFrame([(tok,) for tok in found], schema)
    tokens = df.select(F.explode(tokens_of(F.col(text), marks)).alias("tok"))
    same = F.col("tok") == F.col("_tok")
    chosen = tokens.join(F.broadcast(table), same, "left_semi")
    counts = written(chosen.groupBy("tok").agg(F.count("*").alias("n")), "candidate_counts")
    last = counts.orderBy(F.desc("n")).limit(wanted).agg(F.min("n").alias("n"), F.count("*").alias("k")).first()
    return counts if last["k"] == wanted and last["n"] > missed else None


def encode(
    df: DataFrame,
    key: Sequence[str],
    text: str,
    vocab: DataFrame,
    max_len: int,
    unk_id: int = SPECIALS.index(UNK),
    marks: Sequence[str] = (),
    name: str = "ids",
    inline_rows: int = INLINE_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    head_rows: int | None = None,
) -> DataFrame:
    """Add the ids of the first ``max_len`` tokens of ``text``; unknown tokens get ``unk_id``.

    The size of the vocabulary is checked. Up to ``inline_rows`` it becomes a constant hash table
    in the projection: no exchange at all (0 rules this way out without a look). Of a larger one the
    ``head_rows`` lowest ids (as many as ``inline_rows`` if not given) are such a table, and the
    tokens outside it are joined (see :func:`encode_by_join`); it is read more than once, so pass one
    that is written down or checkpointed. Every form gives the same: a NULL text has NULL ids, an empty
    one none, and neither NULL nor repeated values of ``key`` matter.
    """
    hashed = vocab.select("tok", "id", F.xxhash64("tok").alias("hash"))
    entries = hashed.limit(inline_rows + 1).collect() if inline_rows else None
    if entries is None or len(entries) > inline_rows:
        head = inline_rows if head_rows is None else head_rows
        return encode_by_join(df, key, text, vocab, max_len, unk_id, marks, name, broadcast_rows, head)
    tokens = truncate(tokens_of(F.col(text), marks), max_len)
    known = _look_up(entries)
    unknown = F.lit(unk_id).cast("bigint")
    return df.withColumn(name, F.transform(tokens, lambda tok: F.coalesce(known(tok), unknown)))


def _look_up(entries: list) -> Callable[[Column], Column]:
    """The id of a token, or NULL, by a constant array of small maps, indexed by the token's hash."""
    slots = 1 << max(0, len(entries) - 1).bit_length()
    table: list[dict[str, int]] = [{} for _ in range(slots)]
    for row in entries:
        table[row["hash"] % slots][row["tok"]] = row["id"]
    constant = F.from_json(
        F.lit(json.dumps(table, ensure_ascii=False)), "array<map<string,bigint>>"
    )

    def id_of(tok: Column) -> Column:
        slot = F.pmod(F.xxhash64(tok), F.lit(slots)).cast("int")
        return F.try_element_at(F.get(constant, slot), tok)

    return id_of


def encode_by_join(
    df: DataFrame,
    key: Sequence[str],
    text: str,
    vocab: DataFrame,
    max_len: int,
    unk_id: int = SPECIALS.index(UNK),
    marks: Sequence[str] = (),
    name: str = "ids",
    broadcast_rows: int = BROADCAST_ROWS,
    head_rows: int = 0,
) -> DataFrame:
    """:func:`encode` for a vocabulary too large to be a constant: heavy tokens by a table, light by join.

    The ``head_rows`` lowest ids, in a vocabulary by frequency most of any text, are looked up in the
    projection. Only the other tokens leave their row, with a row id and their place. They are joined with the
    rest of the vocabulary, broadcast up to ``broadcast_rows`` entries and ``BROADCAST_BYTES``, else
    exchanged by token; without the heavy ones no key of that join is hot, and an unknown token that
    is gets split by Spark. At most ``max_len`` tokens of a row are regrouped. Rows are written down with
    their tokens, so that row ids hold; leave columns that are not needed out of ``df``.
    """
    tokens = truncate(tokens_of(F.col(text), marks), max_len)
    table, item = vocab.select("tok", "id"), "array<struct<_i:int, id:bigint>>"
    head = table.withColumn("hash", F.xxhash64("tok")).orderBy("id").limit(head_rows).collect() if head_rows else []
    rows = df.withColumns({"_tokens": tokens, "_row": F.monotonically_increasing_id()})
    if head:
        known = _look_up(head)
        placed = F.transform("_tokens", lambda tok, i: F.struct(i.alias("_i"), known(tok).alias("id"), tok.alias("tok")))
        rows = rows.withColumn("_placed", placed)
        rows = rows.withColumns(
            {
                "_known": F.filter("_placed", lambda x: x["id"].isNotNull()),
                "_rest": F.filter("_placed", lambda x: x["id"].isNull()),
            }
        ).drop("_placed", "_tokens")
        rows = rows.withColumns(
            {
                "_known": F.transform("_known", lambda x: F.struct(x["_i"].alias("_i"), x["id"].alias("id"))),
                "_rest": F.transform("_rest", lambda x: F.struct(x["_i"].alias("_i"), x["tok"].alias("tok"))),
            }
        )
        table = table.filter(F.col("id") > max(row["id"] for row in head))
    else:
        rest = F.transform("_tokens", lambda tok, i: F.struct(i.alias("_i"), tok.alias("tok")))
        none = F.when(F.col("_tokens").isNotNull(), F.array().cast(item))
        rows = rows.withColumns({"_known": none, "_rest": rest}).drop("_tokens")
    rows = written(rows, "tokens")
    exploded = rows.select("_row", F.inline("_rest"))
    size = table.limit(broadcast_rows + 1).agg(F.count("*").alias("n"), F.sum(F.octet_length("tok")).alias("bytes")).first()
    small = size["n"] <= broadcast_rows and (size["bytes"] or 0) <= BROADCAST_BYTES
    found = exploded.join(F.broadcast(table) if small else table, "tok", "left")
    id_ = F.coalesce("id", F.lit(unk_id).cast("bigint")).alias("id")
    grouped = found.groupBy("_row").agg(F.collect_list(F.struct("_i", id_)).alias("_found"))
    every = F.sort_array(F.concat("_known", F.coalesce("_found", F.array().cast(item))))
    joined = rows.join(grouped, "_row", "left")
    return joined.select(*[rows[c] for c in df.columns], F.transform(every, lambda x: x["id"]).alias(name))
