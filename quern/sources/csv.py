"""CSV scans and the CSV sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.sources.quoted_csv import read_quoted_csv


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | None = None,
    *,
    delimiter: str = ",",
    quote: str = '"',
    multiline: bool = False,
    partitions: int | None = None,
    required: tuple[str, ...] = (),
) -> DataFrame:
    """CSV with a header.

    Without ``schema`` the types are inferred, which costs one more pass over
    the file; jobs should pass a schema. ``quote="'"`` reads files quoted with
    apostrophes, while the default keeps apostrophes as part of the value.
    Gzip files are one task each, so ``partitions`` spreads the rows right
    after the scan. CSV columns are always nullable in Spark: columns listed in
    ``required`` make the job fail on the first empty value instead.
    ``multiline`` allows line breaks in quoted values; with a schema one file
    is read by many tasks, while inference reads each file in one.
    """
    reader = spark.read.option("header", True).option("delimiter", delimiter).option("quote", quote)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    if multiline and schema:
        df = read_quoted_csv(spark, path, schema, delimiter=delimiter, quote=quote)
    else:
        df = reader.option("multiLine", multiline).csv(path)
    if partitions:
        df = df.repartition(partitions)
    if required:
        checks = {
            c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is empty"))).otherwise(F.col(c))
            for c in required
        }
        df = df.withColumns(checks)
    return df


def write_csv(
    df: DataFrame, path: str, *, delimiter: str = ",", single_file: bool = False
) -> None:
    """CSV with a header, replacing what is at ``path``.

    The output is one file per task. ``single_file`` is for small exports only:
    it sends all rows through one task.
    """
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("delimiter", delimiter).csv(path)
