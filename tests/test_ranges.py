"""Row order over value ranges: the same results however many ranges there are."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seqprep.operators import batching, ranges, splits
from seqprep.operators.shaping import instruction_pairs


@pytest.fixture(scope="module")
def rows(spark):
    """1,000 rows; group 7 holds a third of them, close together in time."""
    group = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20)
    return (
        spark.range(1000)
        .select(
            group.cast("bigint").alias("g"),
            F.when(F.col("id") % 3 == 0, 500 + F.col("id") / 1000)
            .otherwise(F.col("id").cast("double"))
            .alias("t"),
            F.col("id").alias("seq"),
            (F.col("id") * 7 % 11).alias("v"),
        )
        .repartition(5)
    )


def ordered(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("per_range", [10_000, 90, 7])
def test_position(rows, per_range):
    found = ranges.key_ranges(rows, ["g", "t", "seq"], per_range)
    assert (found.size == 1) == (per_range == 10_000)
    assert found.total == 1000 and sum(found.counts) == 1000
    got = ranges.with_position(rows, found)
    want = rows.withColumn("pos", F.row_number().over(Window.orderBy("g", "t", "seq")) - 1)
    assert ordered(got, "seq", "pos") == ordered(want, "seq", "pos")


@pytest.mark.parametrize("step", [-1, 1])
@pytest.mark.parametrize("per_range", [10_000, 90, 7])
def test_neighbour(rows, per_range, step):
    found = ranges.key_ranges(rows, ["g", "t", "seq"], per_range)
    got = ranges.neighbour(rows, ["g"], ["t", "seq"], ["seq", "v"], found, step, "n")
    window = Window.partitionBy("g").orderBy("t", "seq")
    shift = F.lag if step < 0 else F.lead
    want = rows.withColumn("a", shift("seq").over(window)).withColumn("b", shift("v").over(window))
    assert ordered(got, "seq", F.coalesce("n.seq", F.lit(-1)), F.coalesce("n.v", F.lit(-1))) == ordered(
        want, "seq", F.coalesce("a", F.lit(-1)), F.coalesce("b", F.lit(-1))
    )


def test_few_ranges_are_found_without_a_fold(rows, monkeypatch):
    """A fold over the borders runs outside of generated code, microseconds a row; both find the same ranges."""
    keys = rows.withColumn("g", F.nullif("g", F.lit(3))).withColumn("t", F.when(F.col("seq") % 7 > 0, F.col("t")))
    for per_range in (500, 90, 30):
        found = ranges.key_ranges(keys, ["g", "t", "seq"], per_range)
        assert 1 < found.size <= 64
        tree = keys.select("seq", ranges.range_id(keys, found).alias("at"))
        assert "lambda" not in tree._jdf.queryExecution().optimizedPlan().toString()
        with monkeypatch.context() as patched:
            patched.setattr(ranges, "TREE_RANGES", 1)
            fold = keys.select("seq", ranges.range_id(keys, found).alias("at"))
        assert "lambda" in fold._jdf.queryExecution().optimizedPlan().toString()
        assert ordered(tree, "seq", "at") == ordered(fold, "seq", "at")


@pytest.mark.parametrize("per_range", [10_000, 90, 7])
def test_running_sum(rows, per_range):
    found = ranges.key_ranges(rows, ["g", "t", "seq"], per_range)
    got = ranges.running_sum(rows, ["g"], ["t", "seq"], F.col("v"), found, "run", total="whole")
    window = Window.partitionBy("g").orderBy("t", "seq")
    want = rows.withColumn("run", F.sum("v").over(window)).withColumn(
        "whole", F.sum("v").over(Window.partitionBy("g"))
    )
    assert ordered(got, "seq", "run", "whole") == ordered(want, "seq", "run", "whole")


def test_key_at_descends_to_the_exact_key(spark, monkeypatch):
    monkeypatch.setattr(ranges, "LAST_STEP_ROWS", 20)
    table = spark.range(0, 5000, 5).select((F.col("id") * 2).alias("k")).repartition(3)
    found = ranges.key_ranges(table, ["k"], rows_per_range=300)
    assert found.size > 1
    keys = ranges.key_at(table, found, [0, 1, 499, 998, 999, 1000])
    assert [k and k[0] for k in keys] == [0, 10, 4990, 9980, 9990, None]


@pytest.mark.parametrize(
    ("rows_in", "bound"), [(10, 0), (30, 2), (50, 2), (70, 4), (87, 4)]
)
def test_slice_bound(rows_in, bound):
    assert splits.slice_bound(5, rows_in) == bound


def test_middle_split_drops_the_tail(spark):
    table = spark.range(87).repartition(4)
    got = splits.with_split(table, splits.TAIL_DROPPED, ["id"])
    found = {r["split"]: (r["lo"], r["hi"]) for r in got.groupBy("split").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi")).collect()}
    assert found == {"train": (0, 77), "validation": (78, 82)}


def test_slices_are_disjoint_and_whole(spark):
    table = spark.range(997).select(F.md5(F.col("id").cast("string")).alias("a"), "id")
    key = ["a", "id"]
    parts = [splits.pct_slice(table, key, lo, hi) for lo, hi in [(None, 5), (5, 33), (33, None)]]
    seen = [r["id"] for part in parts for r in part.collect()]
    assert sorted(seen) == list(range(997))
    assert [part.count() for part in parts] == [50, 329 - 50, 997 - 329]


@pytest.mark.parametrize(
    "kind",
    ["string", "double", "date", "timestamp", "int", "timestamp_ntz", "decimal", "wide decimal", "float", "binary", "null first"],
)
def test_slice_by_key_type(spark, kind):
    value = {
        "string": F.format_string("%05d", "id"),
        "double": F.col("id") / 7,
        "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")),
        "timestamp": F.timestamp_micros(F.col("id") * 1_000_001),
        "int": F.col("id").cast("int"),
        "timestamp_ntz": (F.timestamp_micros((F.col("id") - 30) * 777_000_001)).cast("timestamp_ntz"),
        "decimal": ((F.col("id") - 25) / 8).cast("decimal(10,3)"),
        "wide decimal": (F.col("id").cast("decimal(38,0)") * F.lit("1" + "0" * 30).cast("decimal(31,0)")).cast("decimal(38,0)"),
        "float": (F.col("id") / 4).cast("float"),
        "binary": F.unhex(F.format_string("%06X", "id")),
        "null first": F.when(F.col("id") > 0, F.col("id")),
    }[kind]
    table = spark.range(200).select("id", value.alias("k")).repartition(3)
    got = splits.pct_slice(table, ["k"], 10, 30)
    assert sorted(r["id"] for r in got.collect()) == list(range(20, 60))
    two = splits.pct_slice(table, ["k", "id"], 10, 30)
    assert sorted(r["id"] for r in two.collect()) == list(range(20, 60))


def test_null_key_is_first(spark):
    table = spark.range(100).select("id", F.when(F.col("id") != 40, F.col("id")).alias("k"))
    first = splits.pct_slice(table, ["k"], None, 5)
    rest = splits.pct_slice(table, ["k"], 5, None)
    assert sorted(r["id"] for r in first.collect()) == [0, 1, 2, 3, 40]
    assert rest.count() == 95


def test_split_filter_reaches_the_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    part = splits.split_by_rule(docs, splits.FRONT_VALIDATION, ["doc_id"])["train"]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id" in plan
    assert "Exchange" not in plan


def test_missing_split_is_named(spark):
    table = spark.range(10).withColumn("split", F.lit("train"))
    with pytest.raises(ValueError, match="no validation"):
        splits.splits(table)


@pytest.mark.parametrize("per_range", [10_000, 9])
def test_batches_are_full(spark, per_range):
    table = spark.range(100).repartition(7)
    got = batching.assign_batches(table, ["id"], 8, rows_per_range=per_range)
    sizes = {r["batch_id"]: r["count"] for r in got.groupBy("batch_id").count().collect()}
    assert sizes == {i: 8 for i in range(12)}
    assert ordered(got, "id", "batch_id", "slot") == [(i, i // 8, i % 8) for i in range(96)]
    capped = batching.assign_batches(table, ["id"], 8, max_steps=3, rows_per_range=per_range)
    assert capped.count() == 24
    whole = batching.assign_batches(table, ["id"], 8, drop_last=False, rows_per_range=per_range)
    assert whole.count() == 100


def test_batches_of_many_rows_use_many_tasks(spark):
    table = spark.range(1000).repartition(4)
    got = batching.assign_batches(table, ["id"], 8, rows_per_range=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "Exchange hashpartitioning(_range" in plan


def test_ten_rows_in_batches_of_four(spark):
    got = batching.assign_batches(spark.range(10), ["id"], 4)
    assert got.count() == 8
    assert got.select("batch_id").distinct().count() == 2


def test_train_steps(spark):
    assert batching.train_steps(spark.range(1000), 64, 5).collect()[0]["steps"] == 75
    assert batching.train_steps(spark.range(1000), 64, 5, max_steps=40).collect()[0]["steps"] == 40


@pytest.mark.parametrize("digits", [1, 3])
def test_epoch_order_is_a_seeded_permutation(spark, digits):
    rows = batching.with_epochs(spark.range(300), 2)
    got = batching.epoch_order(rows, ["id"], 42, digits)
    window = Window.partitionBy("epoch").orderBy(batching.shuffle_hash(["id"], 42), "id")
    want = rows.withColumn("pos", F.row_number().over(window) - 1)
    assert ordered(got, "epoch", "pos", "id") == ordered(want, "epoch", "pos", "id")
    other = batching.epoch_order(rows, ["id"], 43, digits)
    assert ordered(got, "epoch", "pos", "id") != ordered(other, "epoch", "pos", "id")


def test_epoch_batches_stop_at_max_steps(spark):
    got = batching.assign_epoch_batches(spark.range(100), ["id"], 8, 3, 1, max_steps=20)
    steps = {r["step"]: r["count"] for r in got.groupBy("step").count().collect()}
    assert steps == {s: 8 for s in range(1, 21)}
    assert got.filter("epoch = 1").agg(F.min("step")).collect()[0][0] == 13


@pytest.mark.parametrize("per_range", [10_000, 11])
def test_pairs_of_a_conversation_of_any_length(spark, per_range):
    turns = spark.range(400).select(
        F.when(F.col("id") < 300, 1).otherwise(F.col("id") % 9).alias("conv_id"),
        (F.col("id") * 3).alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.col("id").cast("string").alias("text"),
    )
    got = instruction_pairs(turns, rows_per_range=per_range)
    window = Window.partitionBy("conv_id").orderBy("turn")
    want = (
        turns.withColumn("nr", F.lead("role").over(window))
        .withColumn("response", F.lead("text").over(window))
        .filter("role = 'user' AND nr = 'assistant'")
        .withColumnRenamed("text", "instruction")
    )
    columns = ("conv_id", "turn", "instruction", "response")
    assert got.count() >= 150
    assert ordered(got, *columns) == ordered(want, *columns)


@pytest.mark.parametrize("per_range", [1000, 4])
def test_null_groups_keep_all_rows(spark, per_range):
    table = spark.range(30).select(F.nullif(F.col("id") % 3, F.lit(0)).alias("g"), F.col("id").alias("t"))
    cut = ranges.key_ranges(table, ["g", "t"], per_range)
    summed = ranges.running_sum(table, ["g"], ["t"], F.lit(1), cut, "at", total="of")
    assert sorted(r["at"] for r in summed.filter("g is null").collect()) == list(range(1, 11))
    assert summed.filter("of <> 10").isEmpty() and summed.count() == 30
    beside = ranges.neighbour(table, ["g"], ["t"], ["t"], cut)
    assert beside.filter("neighbour is null").count() == 3


def test_epochs_are_at_least_one_and_max_steps_lengthen(spark):
    with pytest.raises(ValueError):
        batching.with_epochs(spark.range(3), 0)
    got = batching.assign_epoch_batches(spark.range(100), ["id"], 10, 2, 1, max_steps=25)
    assert got.agg(F.max("step")).first()[0] == 25 and got.count() == 250


def places(df, *order):
    """Row numbers by hand, NULL first."""
    rows = df.collect()
    key = lambda r: tuple((r[c] is not None, r[c] if r[c] is not None else 0) for c in order)
    return [r["id"] for r in sorted(rows, key=key)]


@pytest.mark.parametrize("per_range", [10_000, 30])
@pytest.mark.parametrize("order", [["g"], ["g", "h"], ["n", "g"]])
def test_slices_of_a_key_that_rows_share(spark, monkeypatch, order, per_range):
    monkeypatch.setattr(splits, "key_ranges", lambda df, keys, n=per_range: ranges.key_ranges(df, keys, n))
    table = spark.range(200).select(
        "id",
        (F.col("id") * 7 % 5).alias("g"),
        (F.col("id") % 3).cast("string").alias("h"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 2).alias("n"),
    ).repartition(3)
    want = places(table, *order, "id")
    for low, high in [(None, 5), (5, 33), (33, 90), (90, None), (40, 40)]:
        bounds = [0 if low is None else splits.slice_bound(low, 200), 200 if high is None else splits.slice_bound(high, 200)]
        exact = splits.pct_slice(table, order, low, high, ["id"])
        assert sorted(r["id"] for r in exact.collect()) == sorted(want[slice(*bounds)])
    found = splits.split_by_rule(table, {"a": (None, 5), "b": (5, 6), "c": (6, 80), "d": (80, None)}, order)
    ids = [r["id"] for part in found.values() for r in part.collect()]
    assert sorted(ids) == list(range(200)) and [p.count() for p in found.values()] == [10, 2, 148, 40]
    for part, span in zip(found.values(), [(0, 10), (10, 12), (12, 160), (160, 200)]):
        keys = lambda rows: sorted(str([r[c] for c in order]) for r in rows)
        by_id = {r["id"]: r for r in table.collect()}
        assert keys(part.collect()) == keys([by_id[i] for i in want[slice(*span)]])


def test_slices_of_equal_rows(spark):
    table = spark.range(40).select((F.col("id") % 10).alias("k"), F.lit("x").alias("v"), F.lit(None).cast("string").alias("z"))
    assert splits.pct_slice(table, ["k"], None, 5).count() == 2
    got = splits.with_split(table, splits.TAIL_DROPPED, ["k"])
    assert got.columns == ["k", "v", "z", "split"]
    assert {r["split"]: r["count"] for r in got.groupBy("split").count().collect()} == {"train": 36, "validation": 2}
    one = spark.range(30).select(F.lit(1).alias("k"))
    assert [splits.pct_slice(one, ["k"], lo, hi).count() for lo, hi in [(None, 50), (50, None)]] == [15, 15]
    assert splits.pct_slice(one.limit(0), ["k"], None, 50).count() == 0


def pushed(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "PushedFilters" in line]


def test_bounds_of_several_columns_reach_the_scan(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    for low, high, sign in [(25, None, "GreaterThanOrEqual(conv_id"), (None, 75, "LessThanOrEqual(conv_id")]:
        assert any(sign in line for line in pushed(splits.pct_slice(turns, ["conv_id", "turn"], low, high)))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    sliced = splits.pct_slice(events, ["ts"], 10, 20, ["event_id"])
    assert any("GreaterThanOrEqual(ts" in line for line in pushed(sliced))


def test_times_without_a_zone_follow_no_zone(spark):
    """A night in which clocks of the session's zone go back an hour."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        at = F.expr("timestamp_ntz'2024-10-27 00:30:00' + make_interval(0, 0, 0, 0, 0, 0, id * 60)")
        table = spark.range(240).select("id", at.alias("k")).repartition(3)
        got = splits.pct_slice(table, ["k"], 25, 75)
        assert sorted(r["id"] for r in got.collect()) == list(range(60, 180))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_stored_batches_equal_batches_and_exchange_keys_only(spark, tmp_path):
    table = spark.range(157).select("id", F.array(F.col("id"), F.lit(1).cast("bigint")).alias("ids")).repartition(3)
    want = batching.assign_epoch_batches(table, ["id"], 10, 3, 7)
    batching.store_sequences(table, "stored_for_test", str(tmp_path / "stored"))
    got = batching.stored_batches(spark, "stored_for_test", ["id"], 10, 3, 7)
    columns = ("id", "ids", "epoch", "batch_id", "slot", "step")
    assert ordered(got, *columns) == ordered(want, *columns) and got.count() == 3 * 150
    lines = got._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "ids#" in line)
    join = max(i for i, line in enumerate(lines[:scan]) if "SortMergeJoin" in line)
    assert "Bucketed: true" in lines[scan]
    assert not any("Exchange" in line for line in lines[join:scan])
    short = batching.stored_batches(spark, "stored_for_test", ["id"], 10, 1, 7, max_steps=20)
    assert short.agg(F.max("step")).first()[0] == 20
