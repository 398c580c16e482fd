"""Expressions on ML vectors."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def max_element(vector: Column) -> Column:
    """Largest element of a vector, computed in the JVM."""
    return F.array_max(vector_to_array(vector))


def element(vector: Column, index: int) -> Column:
    return vector_to_array(vector)[index]


def register_array_max(spark: SparkSession, name: str = "maxVectorElement") -> None:
    """The same under a name that SQL text can call, over ``array<double>``."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v ARRAY<DOUBLE>) RETURNS DOUBLE RETURN array_max(v)"
    )
