"""Streams over growing folders of Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def file_stream(
    spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """New files of ``path`` as they appear; ``files_per_batch`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
