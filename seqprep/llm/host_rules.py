"""Quality rules with host-level verdicts, in DataFrame functions only.

Each document is judged by two rules on its own text. Failures are counted per host (``source``),
each host's failure rate is shrunk towards the corpus by a beta prior fitted to all hosts (method of
moments), and a host whose shrunk rate passes ``HOST_LIMIT`` fails with all its documents.

Repeated 5-word windows are found inside the row: windows are hashed to 64 bits, and only in texts
that hold one twice are they sorted with their places. Nothing but a few counters leaves the row.

Defined results: a NULL or empty text has no words and fails the first rule; rows without a source
have no host, so only their own rules judge them; repeated rows count and return each. An empty
table gives no rows. No other columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.llm.frames import SPACE_SIGNS, written

WINDOW = 5
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
REPEAT_PERCENT = 20
#: A host fails when more than this share of its documents fails, after shrinking.
HOST_LIMIT = 0.5

_GAP = r"[\x20\x09-\x0D]+"


def _count_of(text: Column, signs: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, signs, ""))


def _dup_lines(text: Column) -> Column:
    with_word = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACE_SIGNS, "") != "")
    return F.struct(with_word.alias("lines"))


def _covered(places: Column) -> Column:
    """Words under windows that start at sorted ``places``."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))

    def step(state: Column, at: Column) -> Column:
        more = at + WINDOW - F.greatest(at, state["reach"])
        return F.struct((state["n"] + more).alias("n"), (at + WINDOW).alias("reach"))

    return F.aggregate(places, start, step, lambda state: state["n"])


def measures(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``source``, the five counts and ``base_failed``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        text.alias("text"),
    )
    rows = rows.select(
        "doc_id",
        "source",
        F.char_length(F.translate("text", SPACE_SIGNS, "")).cast("bigint").alias("word_chars"),
        _count_of(F.col("text"), SYMBOLS).cast("bigint").alias("n_symbols"),
        _dup_lines(F.col("text"))["lines"].alias("lines"),
        F.transform(F.array_remove(F.split("text", _GAP), ""), lambda w: F.xxhash64(w)).alias("words"),
    )
    gram = F.transform(
        F.slice("words", 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))),
        lambda first, i: F.xxhash64(first, *[F.get("words", i + k) for k in range(1, WINDOW)]),
    )
    rows = rows.select(
        "doc_id",
        "source",
        "word_chars",
        "n_symbols",
        F.size("words").cast("bigint").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        gram.alias("grams"),
    )
    placed = F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    repeats = F.size(F.array_distinct("grams")) < F.size("grams")
    rows = rows.withColumn("placed", F.when(repeats, placed)).drop("grams")
    twice = F.filter(
        "placed",
        lambda x, j: (x["g"] == F.get("placed", j - 1)["g"]) | (x["g"] == F.get("placed", j + 1)["g"]),
    )
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    repeated = F.when(F.col("placed").isNull(), 0).otherwise(_covered(places)).cast("bigint")
    rows = rows.withColumn("n_repeat_words", repeated).drop("placed")
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT
    )
    return rows.withColumn("base_failed", failed)


def host_rates(judged: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """``(source, host_rate, host_failed)`` of the hosts in ``judged``.

    With failure counts ``f`` of ``n`` documents, the spread of ``f / n`` beyond the binomial one
    gives the correlation ``rho`` of two documents of a host, and ``1 / rho - 1`` is the weight of
    the prior in documents. The driver sees one row of sums.
    """
    hosts = judged.filter("source is not null").groupBy("source").agg(
        F.count("*").alias("n"), F.sum(F.col("base_failed").cast("bigint")).alias("f")
    )
    total = hosts.agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        F.sum("f").alias("f"),
        F.sum(F.col("f") * F.col("f") / F.col("n")).alias("ff"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
    ).first()
    mean, weight = 0.0, 1.0
    if total["k"]:
        mean = total["f"] / total["n"]
        spread = total["ff"] - total["f"] * mean
        binomial = mean * (1 - mean)
        room = binomial * (total["n"] - total["nn"] / total["n"] - (total["k"] - 1))
        if room > 0:
            rho = (spread - binomial * (total["k"] - 1)) / room
            weight = 1 / min(max(rho, 1e-6), 1.0) - 1
    rate = (F.col("f") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))
    return hosts.select("source", F.round(rate, 6).alias("host_rate")).withColumn(
        "host_failed", F.col("host_rate") > limit
    )


def judge(docs: DataFrame) -> DataFrame:
    """Per row the measures, its host's rate (NULL without a source) and ``kept``.

    The measures are written once; hosts, a row each, are joined back by Spark's choice: broadcast
    below its size threshold, else sorted, with a hot host split.
    """
    judged = written(measures(docs), "measures")
    hosts = host_rates(judged).withColumnRenamed("source", "_host")
    out = judged.join(hosts, judged["source"] == hosts["_host"], "left")
    verdict = ~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False))
    return out.select(*judged.columns, "host_rate", verdict.alias("kept"))
