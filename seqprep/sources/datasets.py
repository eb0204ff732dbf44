"""Named datasets: where their columns, split rule and order come from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.operators.shaping import map_roles
from seqprep.operators.splits import FRONT_VALIDATION, TAIL_DROPPED, SplitRule, with_split
from seqprep.plans.storage import written

FILE, BLOCK, ROW = "source_file", "source_block", "source_row"
# Published splits by file name, such as train-00000-of-00002.parquet.
SPLIT_FILE = r"^(train|validation|valid|dev|test)(?:[-_.]|$)"


@dataclass(frozen=True)
class DatasetSpec:
    """How to read a dataset. Without a split rule it is used as published.

    Without an order key rows are ordered as they lie in their files; rows of one key, too. A
    ``schema`` saves the pass over the data that finds out the types of JSON or CSV files.
    """

    instruction: str = "instruction"
    response: str = "response"
    rule: SplitRule | None = None
    append_eos: bool = False
    keep_labels: bool = True
    format: str = "parquet"
    order_by: Sequence[str] = ()
    schema: str | None = None
    options: Mapping[str, str] | None = None


# Dataset names with their columns and split rules; any other name uses the default.
DATASETS = {
    "bitext/Bitext-customer-support-llm-chatbot-training-dataset": DatasetSpec(
        rule=FRONT_VALIDATION
    ),
    "agileloop/izaz-sequence-of-actions-prediction-dataset-llama2-7b-32k": DatasetSpec(
        "Instruction", "Response", rule=TAIL_DROPPED, keep_labels=False
    ),
    "alespalla/chatbot_instruction_prompts": DatasetSpec(
        "prompt", "response", rule=TAIL_DROPPED, append_eos=True
    ),
    "MBZUAI/LaMini-instruction": DatasetSpec(),
}


def dataset_spec(name: str, registry: dict[str, DatasetSpec] | None = None) -> DatasetSpec:
    return (DATASETS if registry is None else registry).get(name, DatasetSpec())


def read_rows(spark: SparkSession, spec: DatasetSpec, path: str | Sequence[str]) -> DataFrame:
    """The dataset's rows, with their address in the files where a split rule needs it.

    Rows without a ``split`` column or folder get the split that their file is named after, or train.
    """
    reader = spark.read.option("header", "true") if spec.format == "csv" else spark.read
    reader = reader.schema(spec.schema) if spec.schema else reader
    reader = reader.options(**(spec.options or {}))
    paths = [path] if isinstance(path, str) else list(path)
    rows = reader.format(spec.format).load(paths)
    if "split" not in rows.columns:
        named = F.regexp_extract(F.col("_metadata.file_name"), SPLIT_FILE, 1)
        split = F.when(named == "", "train").otherwise(named)
        rows = rows.select("*", "_metadata", split.alias("split"))
    else:
        rows = rows.select("*", "_metadata")
    if spec.rule is None:
        return rows.drop("_metadata")
    if spec.format == "parquet":
        return rows.withColumns(
            {FILE: F.col("_metadata.file_path"), ROW: F.col("_metadata.row_index")}
        ).drop("_metadata")
    return rows.drop("_metadata") if spec.order_by else _addressed(rows)


def _addressed(rows: DataFrame) -> DataFrame:
    """Rows of text files with their address: file, start of the block, and number inside the block.

    A block is read by one task, in the order of its lines. How files are cut into blocks may change
    from one pass to the next, with the cores that happen to be there, so the rows are written down
    with their addresses, which also parses the text once.
    """
    address = {
        FILE: F.col("_metadata.file_path"),
        BLOCK: F.col("_metadata.file_block_start"),
        ROW: F.monotonically_increasing_id(),
    }
    return written(rows.withColumns(address).drop("_metadata"), "addressed")


def read_dataset(
    spark: SparkSession,
    name: str,
    path: str | Sequence[str],
    registry: dict[str, DatasetSpec] | None = None,
) -> DataFrame:
    """Rows of a named dataset with ``instruction``, ``response`` and ``split``.

    A dataset used as published keeps its own splits: a column, ``split=...`` folders, or files named
    after them; one without any is all train. A split rule cuts the published train rows only.
    """
    spec = dataset_spec(name, registry)
    rows = read_rows(spark, spec, path)
    if spec.rule is not None:
        rows = rows.filter("split = 'train'").drop("split")
        address = [c for c in (FILE, BLOCK, ROW) if c in rows.columns]
        order = list(spec.order_by) or address
        ties = address if spec.order_by else []
        rows = with_split(rows, spec.rule, order, ties).drop(FILE, BLOCK, ROW)
    return map_roles(rows, spec.instruction, spec.response)
