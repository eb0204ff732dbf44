"""User row functions over a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: str) -> DataFrame:
    """Apply a user function from row to row; the result has the columns of ``schema``.

    Rows reach Python in Arrow batches and stay in their partition. Everything this package ships is
    a column expression instead; this is for functions that are not.
    """
    shape = to_arrow_schema(StructType.fromDDL(schema))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([fn(row) for row in batch.to_pylist()], shape)

    return df.mapInArrow(apply, schema)
