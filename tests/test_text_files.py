"""Datasets in text files: split by where their rows stand, however the files are cut into blocks."""

from __future__ import annotations

import json

import pytest

from seqprep.operators import splits
from seqprep.plans import catalog, storage
from seqprep.sources import datasets

SCHEMA = "n bigint, instruction string, response string"


def rows_of(count):
    return [(i, f"question {i}", "x" * (i * 37 % 90)) for i in range(count)]


def write(folder, kind, rows, files):
    folder.mkdir()
    each = -(-len(rows) // files)
    for f in range(files):
        part = rows[f * each : (f + 1) * each]
        with open(folder / f"part-{f:03}.{kind}", "w") as out:
            if kind == "csv":
                out.write("n,instruction,response\n")
            for n, question, answer in part:
                line = {"n": n, "instruction": question, "response": answer}
                out.write(json.dumps(line) + "\n" if kind == "json" else f"{n},{question},{answer}\n")


@pytest.fixture
def small_blocks(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "2000")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_split_by_place_over_many_blocks(spark, tmp_path, small_blocks, kind):
    rows = rows_of(1000)
    write(tmp_path / "data", kind, rows, 3)
    spec = datasets.DatasetSpec(rule=splits.TAIL_DROPPED, format=kind, schema=SCHEMA)
    addressed = datasets.read_rows(spark, spec, str(tmp_path / "data"))
    blocks = addressed.select(datasets.FILE, datasets.BLOCK).distinct().count()
    assert blocks > 12
    found = datasets.read_dataset(spark, "d", str(tmp_path / "data"), {"d": spec})
    assert sorted(found.columns) == ["instruction", "n", "response", "split"]
    got = {name: sorted(r["n"] for r in found.filter(found.split == name).collect()) for name in ("train", "validation")}
    assert got == {"train": list(range(900)), "validation": list(range(900, 950))}


def test_text_lines_and_one_empty_file(spark, tmp_path, small_blocks):
    folder = tmp_path / "data"
    folder.mkdir()
    (folder / "a.txt").write_text("".join(f"line {i}\n" for i in range(500)))
    (folder / "b.txt").write_text("")
    spec = datasets.DatasetSpec(rule=splits.FRONT_VALIDATION, format="text")
    rows = datasets.read_rows(spark, spec, str(folder)).drop("split")
    found = splits.with_split(rows, spec.rule, [datasets.FILE, datasets.BLOCK, datasets.ROW])
    first = sorted(int(r["value"].split()[1]) for r in found.filter("split = 'validation'").collect())
    assert first == list(range(25)) and found.count() == 500


def test_a_key_that_rows_share_is_ordered_by_address(spark, tmp_path):
    table = spark.createDataFrame([(i % 4, f"q{i}", i) for i in range(100)], "k int, instruction string, response int")
    table.coalesce(1).write.parquet(str(tmp_path / "data"))
    spec = datasets.DatasetSpec(rule=splits.TAIL_DROPPED, order_by=("k",))
    found = datasets.read_dataset(spark, "d", str(tmp_path / "data"), {"d": spec})
    want = sorted(range(100), key=lambda i: (i % 4, i))
    assert sorted(r["response"] for r in found.filter("split = 'train'").collect()) == sorted(want[:90])
    assert sorted(r["response"] for r in found.filter("split = 'validation'").collect()) == sorted(want[90:95])


def test_csv_files_follow_the_size_of_the_table(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(storage, "PIECE_BYTES", 10_000, raising=False)
    shared = storage.shared_dir(spark)
    before = storage.list_names(spark, shared)
    found = catalog.read_csv_split(spark, sf_dir)
    (written,) = [n for n in storage.list_names(spark, shared) if n.startswith("csv-") and n not in before]
    files = [n for n in storage.list_names(spark, f"{shared}/{written}") if n.startswith("part-")]
    assert len(files) > 20 and found.count() == round(spark.read.parquet(f"{sf_dir}/documents.parquet").count() * 0.95)
