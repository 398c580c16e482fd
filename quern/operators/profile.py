"""Descriptions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def numeric_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, count, mean, stddev, min, max``: one aggregate, one row per column."""
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.stddev_samp(F.col(c).cast("double")).alias("stddev"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return wide.select(F.inline(F.array(*columns)))


def row_count(df: DataFrame, name: str) -> DataFrame:
    """``table, rows`` of one frame."""
    return df.agg(F.lit(name).alias("table"), F.count("*").alias("rows"))


def first_by_key(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """The first row of every key in a total order: a minimum, so it starts in the map tasks."""
    row = F.min(F.struct(*order, *[c for c in columns if c not in order])).alias("_row")
    return df.groupBy(key).agg(row).select(key, *[F.col(f"_row.{c}").alias(c) for c in columns])
