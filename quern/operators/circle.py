"""Pi from points in a square."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import hashing as hs
from quern.functions.maths import in_circle

# Steps of the two-dimensional low-discrepancy sequence (1/g and 1/g^2, g^3 = g + 1).
STEP_X = 0.7548776662466927
STEP_Y = 0.5698402909980532


def hash_points(df: DataFrame, key: Column, seed: int) -> DataFrame:
    """A point in [-1, 1)² per row, from the row's key."""
    return df.select(
        (hs.hash_unit(key, seed, 1) * 2 - 1).alias("x"), (hs.hash_unit(key, seed, 9) * 2 - 1).alias("y")
    )


def even_points(df: DataFrame, index: Column) -> DataFrame:
    """Evenly spread points from an integer index."""
    return df.select(
        ((index * F.lit(STEP_X)) % 1 * 2 - 1).alias("x"), ((index * F.lit(STEP_Y)) % 1 * 2 - 1).alias("y")
    )


def circle_share(points: DataFrame, closed: bool = False) -> DataFrame:
    """samples, inside and the estimate 4 * inside / samples."""
    counted = points.agg(
        F.count("*").alias("samples"), F.sum(in_circle(F.col("x"), F.col("y"), closed)).alias("inside")
    )
    estimate = F.lit(4.0) * F.col("inside") / F.nullif("samples", F.lit(0))
    return counted.select("samples", "inside", F.round(estimate, 6).alias("pi"))
