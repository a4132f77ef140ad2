"""Per-row Python over Arrow batches, with exact integers and true nulls."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def map_rows(df: DataFrame, build: Callable[[], Callable], schema: str) -> DataFrame:
    """One output row per input row.

    ``build`` runs once per task and returns a function of the row's values,
    in column order, that returns the output values as a tuple. Large ids stay
    exact where a column has nulls, which pandas would turn to floats.
    """
    types = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = build()
        for batch in batches:
            rows = [each(*values) for values in zip(*(c.to_pylist() for c in batch.columns))]
            if rows:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, schema=types)

    return df.mapInArrow(run, schema)
