"""Work spread over cores, and a Python function over a column in Arrow batches for what Columns can't say."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType, _parse_datatype_string


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores, dealt to all of them; any other is left as it is, so large inputs are not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ordered_map(df: DataFrame, function: Callable[[Any], Any], *, column: str, result: str, result_type: str, order: str | None = None) -> DataFrame:
    """df with `result` = function(column), rows in `order` if given. Memory is bounded by a batch, and work is spread by partition."""
    kind = _parse_datatype_string(result_type)
    schema = StructType([*df.schema.fields, StructField(result, kind)])
    at, arrow = df.columns.index(column), to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([function(x) for x in batch.column(at).to_pylist()], arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, result])

    out = df.mapInArrow(run, schema)
    return out.orderBy(order) if order else out
