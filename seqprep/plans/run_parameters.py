"""Parameters of the published training runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Model, train batch, eval batch, block size, epochs, learning rate, log interval.
RUN_PARAMETERS = [
    ("huggyllama/llama-30b", 32, 16, 1024, 5, 0.00001, 20),
    ("meta-llama/Llama-2-7b-chat-hf", 64, 32, 1024, 5, 0.00001, 20),
    ("meta-llama/Llama-2-13b-chat-hf", 32, 8, 1024, 5, 0.00001, 20),
    ("meta-llama/Meta-Llama-2-70b-hf", 256, 64, 1024, 5, 0.00001, 20),
    ("meta-llama/Meta-Llama-3-8B-Instruct", 64, 32, 1024, 1, 0.00001, 20),
    ("meta-llama/Meta-Llama-3-70B-Instruct", 256, 64, 1024, 3, 0.0001, 20),
    ("meta-llama/Meta-Llama-3-70B-Instruct (LoRA)", 16, 16, 1024, 3, 0.0001, 20),
    ("Qwen/Qwen2-72B-Instruct", 32, 32, 1024, 5, 0.00001, 20),
]


def run_parameters(spark: SparkSession) -> DataFrame:
    """The eight parameter sets, numbered from 0."""
    rows = [(i, *row) for i, row in enumerate(RUN_PARAMETERS)]
    return spark.createDataFrame(
        rows,
        "preset bigint, model string, train_batch bigint, eval_batch bigint, block bigint, "
        "epochs bigint, lr double, log_interval bigint",
    )
