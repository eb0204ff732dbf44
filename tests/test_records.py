"""Sources, records, logs, materialised tables."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from seqprep.operators import aggregates, shaping, splits
from seqprep.operators.rows import map_rows
from seqprep.plans import storage
from seqprep.sources import chat_records, datasets, run_logs

# The one response record that is documented, with its model name left open.
SAMPLE = """{"id":"chatcmpl-abc123","object":"chat.completion","created":1744950029,
"model":"m","choices":[{"index":0,"message":{"role":"assistant","reasoning_content":null,
"content":" The winning team","tool_calls":[]},"logprobs":null,"finish_reason":"stop",
"stop_reason":null}],"usage":{"prompt_tokens":35,"total_tokens":91,"completion_tokens":56,
"prompt_tokens_details":null},"prompt_logprobs":null}"""


@pytest.fixture(scope="module")
def long_talk(spark):
    """Conversation 1 has 50 turns, 2 starts with a system turn, 3 has one turn."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f'say "{t}"\n') for t in range(50)]
    rows += [(2, 0, "system", "s"), (2, 1, "user", "u"), (2, 5, "tool", "x"), (3, 7, "user", "é")]
    return spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").repartition(4)


def joined(parts, column):
    texts = {}
    for row in sorted(parts.collect(), key=lambda r: (r["conv_id"], r["part"])):
        texts[row["conv_id"]] = texts.get(row["conv_id"], "") + row[column]
    return texts


def test_a_long_conversation_is_rendered_in_parts(long_talk):
    whole = joined(shaping.render_conversations(long_talk), "text")
    parts = shaping.render_conversations(long_talk, part_turns=4)
    assert parts.filter("conv_id = 1").count() == 13
    assert joined(parts, "text") == whole
    assert whole[2] == "s<reserved_102>u"
    ended = shaping.render_conversations(long_talk, generation_marker="<g>", part_turns=4)
    assert joined(ended, "text") == {k: v + "<g>" for k, v in whole.items()}


def test_a_request_in_parts_is_the_same_record(long_talk):
    whole = joined(chat_records.to_chat_requests(long_talk, 'm "}', 9), "body")
    assert joined(chat_records.to_chat_requests(long_talk, 'm "}', 9, part_turns=4), "body") == whole
    record = json.loads(whole[1])
    assert list(record) == ["model", "messages", "max_tokens"]
    assert record["model"] == 'm "}' and record["max_tokens"] == 9
    assert [m["content"] for m in record["messages"]] == [f'say "{t}"\n' for t in range(50)]
    assert json.loads(whole[2])["messages"][0] == {"role": "system", "content": "s"}


def test_requests_are_written_one_to_a_line(spark, long_talk, tmp_path):
    path = str(tmp_path / "requests")
    chat_records.write_chat_requests(chat_records.to_chat_requests(long_talk, "m", 9), path)
    assert spark.read.json(path).count() == 3
    parts = chat_records.to_chat_requests(long_talk, "m", 9, part_turns=4)
    chat_records.write_chat_requests(parts, path)
    assert spark.read.json(path).count() == parts.filter("parts = 1").count() < 3


def test_requests_of_several_parts_are_written_too(spark, long_talk, tmp_path):
    path = str(tmp_path / "requests")
    parts = chat_records.to_chat_requests(long_talk, "m", 9, part_turns=4)
    chat_records.write_chat_requests(parts, path)
    back = spark.read.schema(parts.schema).json(f"{path}_parts")
    long = parts.filter("parts > 1")
    assert sorted(back.collect()) == sorted(long.collect()) and long.count() > 1
    chat_records.write_chat_requests(parts.filter("parts = 1"), path)
    assert spark.read.schema(parts.schema).json(f"{path}_parts").isEmpty()


def test_parts_go_by_rank(spark, long_talk):
    moved = long_talk.withColumn("turn", F.col("turn") + 1020)
    plain = chat_records.to_chat_requests(long_talk, "m", 9, part_turns=4)
    assert sorted(chat_records.to_chat_requests(moved, "m", 9, part_turns=4).collect()) == sorted(plain.collect())


def test_a_step_behind_a_progress_bar_is_read(spark, tmp_path):
    line = "[Step 20] | TPS: 10.00 tokens/sec | Loss: 1.000000 | LR : 0.10000000 | Duration for 1 Step: 2.00 sec"
    (tmp_path / "r_240101_000000.log").write_text(f" 40%|####      | 20/50 [00:01<00:02]{line}\nnoise\n")
    assert [r["step"] for r in run_logs.read_run_logs(spark, str(tmp_path)).collect()] == [20]


def test_published_splits_of_files(spark, tmp_path):
    for name, ids in (("train", range(20)), ("test", range(20, 30))):
        spark.range(ids.start, ids.stop).coalesce(1).selectExpr("id", "'a' instruction", "'b' response").write.parquet(f"{tmp_path}/{name}")
        part = next((tmp_path / name).glob("part-*.parquet"))
        (tmp_path / "d").mkdir(exist_ok=True)
        part.rename(tmp_path / "d" / f"{name}-00000-of-00001.parquet")
    rows = datasets.read_dataset(spark, "any", f"{tmp_path}/d")
    assert {(r["split"], r["count"]) for r in rows.groupBy("split").count().collect()} == {("train", 20), ("test", 10)}
    rule = datasets.DatasetSpec(rule=splits.TAIL_DROPPED)
    cut = datasets.read_dataset(spark, "d", f"{tmp_path}/d", {"d": rule})
    assert sorted(r["id"] for r in cut.filter("split = 'train'").collect()) == list(range(18))


def test_response_record(spark):
    rows = spark.createDataFrame([(1, SAMPLE), (2, "no record"), (3, '{"id":"e","choices":[]}')],
                                 "k int, body string")
    typed = chat_records.read_chat_responses(rows, "body")
    found = {r["k"]: r.asDict() for r in typed.collect()}
    assert found[1]["content"] == " The winning team" and found[1]["created"] == 1744950029
    assert found[1]["tool_calls"] == [] and found[1]["reasoning_content"] is None
    assert found[2]["id"] is None
    assert found[3]["id"] == "e" and found[3]["choice"] is None
    totals = aggregates.usage_rollup(typed.filter("k = 1"), ["model"]).collect()[0].asDict()
    assert totals == {"model": "m", "responses": 1, "prompt_tokens": 35, "completion_tokens": 56,
                      "total_tokens": 91, "consistent": 1}


def test_usage_counts_a_record_once(spark):
    twice = SAMPLE.replace('"choices":[', '"choices":[{"index":1,"finish_reason":"length"},')
    typed = chat_records.read_chat_responses(spark.createDataFrame([(twice,)], "body string"), "body")
    assert typed.count() == 2
    total = aggregates.usage_rollup(typed, ["model"]).collect()[0]
    assert (total["responses"], total["total_tokens"]) == (1, 91)


def test_flagged_share(spark):
    rows = spark.createDataFrame([(10, True), (30, False)], "v bigint, f boolean")
    assert tuple(aggregates.flagged_share(rows, F.col("v"), F.col("f")).collect()[0]) == (10, 40, 25.0)
    none = aggregates.flagged_share(rows, F.col("v"), F.lit(False)).collect()[0]
    assert tuple(none) == (0, 40, 0.0)


LOG = """Loading model
[Step 1] | TPS: 12.50 tokens/sec | Loss: 2.500000 | LR : 0.00001000 | Duration for 1 Step: 3.25 sec
[Step 20] | TPS: 131072.00 tokens/sec | Loss: nan | LR : 0.00000950 | Duration for 1 Step: 0.50 sec

          Performance Summary           
==================================================
Total Duration:                130.00 seconds
  Model Loading Duration:      30.00 seconds
  Train Duration:              90.00 seconds
  Evaluation Duration:         10.00 seconds
Total Estimated Duration:      1 day, 0:01:59.500000 for 1 epochs
Avg TPS:                       131072.00 tps
==================================================
Start: Mon Jan  1 09:00:00 KST 2024
"""


def test_run_log_lines(spark, tmp_path):
    for name in ("240101_090000.log", "240102_090000.log"):
        (tmp_path / name).write_text(LOG)
    rows = run_logs.read_run_logs(spark, str(tmp_path / "*.log")).filter("log = '240101_090000'")
    found = rows.collect()
    steps = {r["step"]: r for r in found if r["kind"] == "step"}
    assert steps[1]["tps"] == 12.5 and steps[1]["seconds_per_step"] == 3.25
    assert steps[20]["loss"] != steps[20]["loss"] and steps[20]["learning_rate"] == 0.0000095
    values = {r["label"]: r["value"] for r in found if r["kind"] == "summary"}
    assert values == {
        "Total Duration": 130.0,
        "Model Loading Duration": 30.0,
        "Train Duration": 90.0,
        "Evaluation Duration": 10.0,
        "Total Estimated Duration": 86_519.5,
        "Avg TPS": 131_072.0,
    }
    assert {r["started"].day for r in found} == {1}
    assert [r["mark"] for r in found if r["kind"] == "mark"] == ["Mon Jan  1 09:00:00 KST 2024"]


def test_unknown_lines_are_counted_and_lines_keep_their_order(spark, tmp_path):
    odd = "loading shards\n[Step x] | TPS: 1\n  5%|#| 1/2 [00:01] [Step 7] | TPS: 1.00 tokens/sec | Loss: 2.0 | LR : 0.1 | Duration for 1 Step: 3 sec it/s\n"
    (tmp_path / "a_240101_090000.log").write_text(odd + LOG + "\x01\x01\x01\nStarted: no\n")
    rows = run_logs.read_run_logs(spark, str(tmp_path), keep_unknown=True).orderBy("block", "place").collect()
    assert len(rows) == len((odd + LOG).splitlines()) + 2
    known = [r for r in rows if r["kind"] != "unknown"]
    assert [(r["step"], r["tps"]) for r in known if r["kind"] == "step"][0] == (7, 1.0)
    assert {r["line"] for r in rows if r["kind"] == "unknown"} >= {"loading shards", "[Step x] | TPS: 1", "\x01\x01\x01", "Started: no"}
    assert len(run_logs.read_run_logs(spark, str(tmp_path)).collect()) == len(known)
    table = spark.createDataFrame(
        [(1, i, line) for i, line in enumerate((odd + LOG).splitlines())], "run_id int, ord int, line string"
    ).withColumn("started", F.lit("2024-01-01 09:00:00").cast("timestamp"))
    run_logs.write_packed_logs(table, f"{tmp_path}/packed")
    packed = run_logs.read_packed_logs(spark, f"{tmp_path}/packed").orderBy("place").collect()
    drop = ("run", "block", "place")
    plain = lambda found: [str({k: v for k, v in r.asDict().items() if k not in drop}) for r in found]
    assert plain(packed) == plain(known) and {r["run"] for r in packed} == {"1"}


def test_rendered_lines_have_the_documented_form(spark):
    row = spark.range(1).select(
        F.lit(20).cast("bigint").alias("step"), F.lit(131072.0).alias("tps"), F.lit(float("nan")).alias("loss"),
        F.lit(0.0000095).alias("learning_rate"), F.lit(0.5).alias("seconds_per_step"),
        F.lit(130.0).alias("total_seconds"), F.lit(30.0).alias("warm_up_seconds"),
        F.lit(90.0).alias("train_seconds"), F.lit(10.0).alias("eval_seconds"),
        F.lit(1).cast("bigint").alias("estimated_days"), F.lit(119.5).alias("estimated_rest_seconds"),
        F.lit(131072.0).alias("avg_tps"),
    )
    line, report = row.select(run_logs.step_line(), run_logs.summary_lines(1)).collect()[0]
    assert line in LOG.splitlines()
    assert [r for r in report if r not in LOG.splitlines()] == []


def test_materialised_once(spark, tmp_path):
    df = spark.range(20).withColumn("split", F.when(F.col("id") < 5, "validation").otherwise("train"))
    first = storage.materialise(df, str(tmp_path), "f")
    again = storage.materialise(df.filter("id < 3"), str(tmp_path), "f")
    assert first.count() == again.count() == 20
    assert again.columns == df.columns
    plan = again.filter("split = 'train'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_a_table_of_another_schema_is_refused(spark, tmp_path):
    df = spark.range(5).withColumn("split", F.lit("train"))
    storage.materialise(df, str(tmp_path), "f", parameters={"block": 8})
    for other, given, said in (
        (df.withColumn("more", F.lit(1)), {"block": 8}, "columns: more"),
        (df.withColumn("id", F.col("id").cast("string")), {"block": 8}, "columns: id"),
        (df, {"block": 9}, "parameters: block"),
    ):
        with pytest.raises(ValueError, match=said):
            storage.materialise(other, str(tmp_path), "f", parameters=given)
    assert storage.materialise(df, str(tmp_path), "f", parameters={"block": 8}).count() == 5


def test_two_writers_give_one_table(spark, tmp_path):
    """Both find nothing and write; the later rename finds the name taken."""
    rows = [spark.range(n).withColumn("split", F.lit("train")) for n in (5, 9)]
    for i, df in enumerate(rows):
        df.write.partitionBy("split").parquet(f"{tmp_path}/_aside{i}")
        storage._write_text(spark, f"{tmp_path}/_aside{i}/{storage.MANIFEST}", "{}")
    for i in (0, 1):
        storage._commit(spark, f"{tmp_path}/_aside{i}", f"{tmp_path}/f")
    assert spark.read.parquet(f"{tmp_path}/f").count() == 5
    assert storage.list_names(spark, str(tmp_path)) == ["f"]


def test_an_unfinished_write_is_replaced(spark, tmp_path):
    df = spark.range(20).withColumn("split", F.lit("train"))
    storage.materialise(df, str(tmp_path), "f")
    (tmp_path / "f" / "_SUCCESS").unlink()
    assert storage.materialise(df.filter("id < 3"), str(tmp_path), "f").count() == 3


def test_fingerprint_depends_on_files_and_parameters(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    other = spark.read.parquet(f"{sf_dir}/events.parquet")
    names = {storage.fingerprint(docs, n=1), storage.fingerprint(docs, n=2), storage.fingerprint(other, n=1)}
    assert len(names) == 3
    assert storage.fingerprint(docs, n=1) in names


def test_fingerprint_changes_with_the_content_of_a_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    before = storage.fingerprint(spark.read.parquet(path))
    spark.range(5, 9).write.mode("append").parquet(path)
    assert storage.fingerprint(spark.read.parquet(path)) != before


def test_shared_folder_is_the_named_one(spark):
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert storage.scratch_path(spark, "x").startswith(storage.shared_dir(spark))


def write(spark, path, n, **columns):
    df = spark.range(n).select(*[F.concat(F.lit(v), "id").alias(k) for k, v in columns.items()], "id")
    df.coalesce(1).write.parquet(str(path))


def test_named_dataset_in_file_order(spark, tmp_path):
    path = tmp_path / "bitext"
    write(spark, path, 40, instruction="i", response="r")
    name = "bitext/Bitext-customer-support-llm-chatbot-training-dataset"
    rows = datasets.read_dataset(spark, name, str(path))
    assert set(rows.columns) == {"id", "instruction", "response", "split"}
    assert sorted(r["id"] for r in rows.filter("split = 'validation'").collect()) == [0, 1]
    assert rows.count() == 40


def test_named_dataset_with_capitals_and_dropped_tail(spark, tmp_path):
    path = tmp_path / "capitals"
    write(spark, path, 40, Instruction="i", Response="r")
    name = "agileloop/izaz-sequence-of-actions-prediction-dataset-llama2-7b-32k"
    rows = datasets.read_dataset(spark, name, str(path))
    counts = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    assert counts == {"train": 36, "validation": 2}
    assert rows.filter("id = 3").collect()[0]["instruction"] == "i3"
    assert not datasets.dataset_spec(name).keep_labels


def test_published_dataset_keeps_its_splits(spark, tmp_path):
    path = tmp_path / "published"
    write(spark, path / "split=train", 4, instruction="i", response="r")
    write(spark, path / "split=validation", 2, instruction="i", response="r")
    rows = datasets.read_dataset(spark, "anything", str(path))
    assert rows.groupBy("split").count().count() == 2
    bare = datasets.read_dataset(spark, "anything", str(path / "split=train"))
    assert [r["split"] for r in bare.select("split").distinct().collect()] == ["train"]


def test_prompt_dataset_from_json(spark, tmp_path):
    path = tmp_path / "json"
    rows = spark.range(20).select(F.concat(F.lit("p"), "id").alias("prompt"), F.lit("r").alias("response"), "id")
    rows.write.json(str(path))
    spec = datasets.DatasetSpec("prompt", "response", rule=datasets.TAIL_DROPPED, format="json")
    placed = datasets.read_dataset(spark, "j", str(path), {"j": spec})
    assert [placed.filter(F.col("split") == n).count() for n in ("train", "validation")] == [18, 1]
    keyed = datasets.DatasetSpec(
        "prompt", "response", rule=datasets.TAIL_DROPPED, format="json", order_by=("id",)
    )
    got = datasets.read_dataset(spark, "j", str(path), {"j": keyed})
    assert sorted(r["id"] for r in got.filter("split = 'validation'").collect()) == [18]


def test_map_rows(spark):
    rows = spark.createDataFrame([(1, None), (2, "ab")], "k bigint, t string").repartition(3)
    got = map_rows(rows, lambda r: {**r, "n": len(r["t"] or "")}, "k bigint, t string, n int")
    assert sorted(tuple(r) for r in got.collect()) == [(1, None, 0), (2, "ab", 2)]


def test_wrong_input_is_refused_before_it_runs(spark):
    with pytest.raises(TypeError, match="missing"):
        shaping.require_columns(spark.range(1), {"id": "bigint", "x": "string"})


def test_responses_of_any_shape(spark):
    bodies = [
        (1, '{"id":"a","created":"soon","choices":[{"index":0,"message":{"content":"x","tool_calls":[{"id":"c","n":[1,2]}]}},{"index":1}],"new":{"k":[true]}}'),
        (2, '{"choices":{"index":0}}'), (3, "{broken"), (4, None), (5, "[]"), (6, '{"usage":{"total_tokens":7}}'), (7, ""),
    ]
    rows, broken = chat_records.read_any_responses(spark.createDataFrame(bodies, "k int, body string"), "body")
    got = rows.withColumns({c: F.to_json(c) for c in ("tool_calls", "record")}).collect()
    first = [r for r in got if r["k"] == 1]
    assert [(r["choice"], r["content"], r["tool_calls"]) for r in first] == [(0, "x", '[{"id":"c","n":[1,2]}]'), (1, None, None)]
    assert all(r["created"] is None and '"new":{"k":[true]}' in r["record"] and '"created":"soon"' in r["record"] for r in first)
    assert sorted(r["k"] for r in got if r["k"] > 1) == [2, 4, 5, 6]
    assert {r["k"]: r["total_tokens"] for r in got if r["k"] in (4, 6)} == {4: None, 6: 7}
    assert sorted(map(tuple, broken.collect())) == [(3, "{broken"), (7, "")]
