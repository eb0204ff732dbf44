"""Vocabulary and encoding, in each of the three ways."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seqprep.operators import vocab
from seqprep.plans import prepare

TEXTS = [
    "The cat, the dog.",
    "",
    "the the the zebra",
    "Cat dog cat \n café",
    None,
    "a<reserved_102>b</s>",
]


def tokens(text, marks=()):
    pattern = "|".join([*map(re.escape, marks), vocab.TOKEN_PATTERN])
    return re.findall(pattern, (text or "").lower(), re.ASCII)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "k bigint, text string").repartition(3, "k")


def test_vocab_is_ordered_by_count_then_token(spark, docs):
    got = {r["tok"]: r["id"] for r in vocab.build_vocab(docs, "text", 5).collect()}
    counts = Counter(t for text in TEXTS for t in tokens(text))
    ranked = sorted(counts, key=lambda t: (-counts[t], t.encode()))[:5]
    assert got == {t: i for i, t in enumerate([*vocab.SPECIALS, *ranked])}


def test_vocab_of_marked_text(spark, docs):
    marks = ("<reserved_102>", "</s>")
    words = vocab.build_vocab(docs, "text", 100, (*vocab.SPECIALS, "<reserved_102>"), marks)
    found = [r["tok"] for r in words.collect()]
    assert len(found) == len(set(found))
    assert found[:4] == ["<pad>", "<unk>", "</s>", "<reserved_102>"]
    assert "<" not in found


def test_counts_of_long_words_and_odd_spaces(spark):
    texts = [
        "  lead\tand\x0btrail \n",
        "a" * 50 + " a",
        "\u4e00\u4e8c\u4e00" * 20,
        "x.y,z" * 9 + "\xa0q</s>" * 3,
        " ",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for marks in ((), ("</s>",)):
        got = {r["tok"]: r["n"] for r in vocab.count_tokens(rows, "text", marks).collect()}
        assert got == Counter(t for text in texts for t in tokens(text, marks))


def test_a_mark_with_a_space_is_refused(spark, docs):
    with pytest.raises(ValueError, match="space"):
        vocab.count_tokens(docs, "text", ("a b",))


WAYS = {
    "inline": {},
    "broadcast": {"inline_rows": 0},
    "exchanged": {"inline_rows": 0, "broadcast_rows": 0},
    "head and broadcast": {"inline_rows": 0, "head_rows": 2},
    "head and exchanged": {"inline_rows": 0, "head_rows": 5, "broadcast_rows": 0},
    "head is all": {"inline_rows": 0, "head_rows": 1000},
    "too large to be inline": {"inline_rows": 2},
}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("size", [4, 100])
def test_encode(spark, docs, way, size):
    words = vocab.build_vocab(docs, "text", size)
    table = {r["tok"]: r["id"] for r in words.collect()}
    rows = docs.na.fill({"text": ""})
    got = vocab.encode(rows, ["k"], "text", words, 4, **WAYS[way])
    want = {k: [table.get(t, 1) for t in tokens(text)][:4] for k, text in enumerate(TEXTS)}
    assert {r["k"]: r["ids"] for r in got.collect()} == want


def test_inline_encoding_exchanges_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = vocab.build_vocab(docs, "text", 100)
    plan = vocab.encode(docs, ["doc_id"], "text", words, 16)._jdf.queryExecution()
    assert "Exchange" not in plan.executedPlan().toString()


def test_broadcast_encoding_regroups_without_a_second_exchange(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    words = spark.createDataFrame([("a", 0), ("b", 1)], "tok string, id bigint")
    got = vocab.encode(docs, ["doc_id"], "text", words, 16, inline_rows=0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc_id") <= 2
    assert "Exchange hashpartitioning(tok" not in plan


def test_heavy_tokens_stay_in_their_row(spark):
    """The plan explodes what the head leaves, and copies no vocabulary."""
    docs = spark.createDataFrame([(i, "a b c d " * 5) for i in range(20)], "k bigint, text string")
    words = vocab.build_vocab(docs, "text", 10)
    got = vocab.encode_by_join(docs, ["k"], "text", words, 16, broadcast_rows=0, head_rows=6)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan and plan.count("Generate inline") == 1
    assert all(len(r["ids"]) == 16 for r in got.collect())


@pytest.mark.parametrize("top_rows", [100_000, 3])
def test_vocab_is_the_same_by_ranges(spark, sf_dir, monkeypatch, top_rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {r["tok"]: r["id"] for r in vocab.build_vocab(docs, "text", 200).collect()}
    monkeypatch.setattr(vocab, "TOP_ROWS", top_rows)
    monkeypatch.setattr(vocab, "RANK_ROWS", 500)
    assert {r["tok"]: r["id"] for r in vocab.build_vocab(docs, "text", 200).collect()} == want


def test_sketched_vocab_is_exact_or_not_used(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for size, tracked, used in [(50, 50_000, True), (200, 100, False), (20_000, 30_000, False)]:
        want = vocab.build_vocab(docs, "text", size).collect()
        found = vocab.candidate_counts(docs, "text", size + 3, tracked)
        assert (found is not None) == used, (size, tracked)
        got = vocab.build_vocab(docs, "text", size, tracked=tracked).collect()
        assert {r["tok"]: r["id"] for r in got} == {r["tok"]: r["id"] for r in want}


def test_a_sketch_of_distinct_tokens_gives_way(spark):
    docs = spark.range(500).select(F.concat_ws(" ", F.lit("x"), *[F.concat(F.lit(f"w{j}z"), "id") for j in range(20)]).alias("t"))
    assert vocab.candidate_counts(docs, "t", 3, 100) is None
    assert [r["tok"] for r in vocab.build_vocab(docs, "t", 1, specials=(), tracked=2_000).collect()] == ["x"]
    assert vocab.build_vocab(docs.limit(0), "t", 5, tracked=50).count() == 3


def test_sequences_have_one_length(spark, docs):
    rows = docs.na.fill({"text": ""})
    words = vocab.build_vocab(rows, "text", 50)
    out = prepare.prepare_sequences(rows, ["k"], words, 6)
    for row in out.collect():
        real = len(tokens(TEXTS[row["k"]]))
        assert {len(row[c]) for c in ("input_ids", "attention_mask", "labels", "position_ids")} == {6}
        assert sum(row["attention_mask"]) == min(real, 6)
        assert row["labels"] == row["input_ids"]
        assert row["position_ids"] == list(range(6))
        assert all(i == 0 for i, m in zip(row["input_ids"], row["attention_mask"]) if m == 0)


def test_sequences_without_labels(spark, docs):
    rows = docs.na.fill({"text": ""})
    words = vocab.build_vocab(rows, "text", 50)
    assert "labels" not in prepare.prepare_sequences(rows, ["k"], words, 6, keep_labels=False).columns


def test_counting_combines_before_the_exchange(spark, docs):
    plan = vocab.count_tokens(docs, "text")._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_sum" in plan
    assert docs.select(F.size(vocab.tokens_of(F.col("text")))).count() == len(TEXTS)


@pytest.mark.parametrize("sizes", WAYS.values())
def test_null_text_and_repeated_keys_encode_alike(spark, sizes):
    rows = [(None, "a b"), (1, "a"), (1, None), (2, ""), (1, "b")]
    table = spark.createDataFrame(rows, "k bigint, t string").repartition(2)
    words = spark.createDataFrame([("a", 3), ("b", 4)], "tok string, id bigint")
    found = vocab.encode(table, ["k"], "t", words, 8, **sizes).collect()
    assert {(r["k"], r["t"]): r["ids"] for r in found} == {
        (None, "a b"): [3, 4], (1, "a"): [3], (1, None): None, (2, ""): [], (1, "b"): [4],
    }
