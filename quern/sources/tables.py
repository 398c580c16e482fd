"""Parquet tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def register(views: dict[str, DataFrame]) -> None:
    """Make frames available to ``spark.sql`` under the given names."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows over all cores when the scan has fewer splits than there are cores.

    For work that is heavy per row (tokenising) on a table of few files. The rows are dealt in turn, not by a key, so
    the plan above is the same with and without it; a table with enough splits, as any large one, is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with long texts, spread over the cores."""
    return spread(table(spark, sf_dir, name))
