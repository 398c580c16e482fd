"""Tables built in code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def from_strings(spark: SparkSession, values: Iterable[str], name: str = "value") -> DataFrame:
    """One string column."""
    return spark.createDataFrame([(v,) for v in values], f"`{name}` STRING")


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Rows with a declared schema."""
    return spark.createDataFrame(list(rows), schema)
