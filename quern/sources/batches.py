"""Row and batch access to a frame."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def first_rows(df: DataFrame, n: int) -> Iterator[Row]:
    """The first ``n`` rows, fetched one partition at a time."""
    return df.limit(n).toLocalIterator()


def map_batches(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    batch_size: int,
) -> DataFrame:
    """Apply ``fn`` to pandas batches of ``batch_size`` rows in the tasks; the last one of a task may be smaller."""

    out = T.StructType.fromDDL(schema)
    kinds = to_arrow_schema(out)
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]

    def told(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).to_pandas(date_as_object=True)
        for name in zoned:
            rows[name] = rows[name].dt.tz_localize(None)
        found = fn(rows)
        return pa.RecordBatch.from_pandas(found[kinds.names], schema=kinds, preserve_index=False)

    def run(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows become pandas objects when their batch is full, not before.
        held: list[pa.RecordBatch] = []
        rows = 0
        for chunk in chunks:
            start = 0
            while start < chunk.num_rows:
                held.append(chunk.slice(start, batch_size - rows))
                rows += held[-1].num_rows
                start += held[-1].num_rows
                if rows == batch_size:
                    yield told(held)
                    held, rows = [], 0
        if rows:
            yield told(held)

    return df.mapInArrow(run, out)
