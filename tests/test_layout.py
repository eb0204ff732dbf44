"""Results do not depend on how rows are placed."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from seqprep.operators import batching, shaping, splits, telemetry, vocab
from seqprep.plans import inputs
from seqprep.sources import chat_records


@pytest.fixture(params=[(1, 1), (3, 7)], ids=["one task", "many tasks"])
def placed(request, spark):
    """A function that places the rows of a table; exchanges use as many tasks."""
    shuffles, pieces = request.param
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    yield lambda df: df.repartition(pieces)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def rows(df):
    return sorted(map(str, df.collect()))


def reports(place, spark, sf_dir):
    docs = place(inputs.table(spark, sf_dir, "documents").select("doc_id", "text"))
    turns = place(inputs.table(spark, sf_dir, "conversations"))
    events = place(inputs.run_events(spark, sf_dir, rows_per_range=200))
    words = vocab.build_vocab(docs, "text", 300)
    ids = vocab.encode(docs, ["doc_id"], "text", words, 32).drop("text")
    summary = telemetry.run_summary(events, 1024, F.col("train_batch"), 5, rows_per_range=50)
    return {
        "split": rows(splits.with_split(docs.drop("text"), splits.TAIL_DROPPED, ["doc_id"])),
        "vocab": rows(words),
        "ids": rows(ids),
        "ids by join": rows(
            vocab.encode(docs, ["doc_id"], "text", words, 32, inline_rows=0, broadcast_rows=0)
            .select(*ids.columns)
        ),
        "batches": rows(batching.assign_batches(docs.drop("text"), ["doc_id"], 16, rows_per_range=30)),
        "epochs": rows(batching.assign_epoch_batches(docs.drop("text"), ["doc_id"], 16, 2, 7)),
        "pairs": rows(shaping.instruction_pairs(turns, rows_per_range=20)),
        "chats": rows(shaping.render_conversations(turns, generation_marker="<g>", part_turns=2)),
        "requests": rows(chat_records.to_chat_requests(turns, "m", 5, part_turns=2)),
        "summary": rows(summary.withColumn("avg_tps", F.round("avg_tps", 6))),
    }


@pytest.fixture(scope="module")
def expected(spark, sf_dir):
    return reports(lambda df: df, spark, sf_dir)


def test_results_do_not_depend_on_placement(placed, spark, sf_dir, expected):
    found = reports(placed, spark, sf_dir)
    assert {name for name in expected if found[name] != expected[name]} == set()
    assert found["ids"] == found["ids by join"]
    assert all(found.values())
