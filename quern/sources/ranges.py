"""Generated ranges and evenly spaced grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def index_range(spark: SparkSession, n: int, partitions: int) -> DataFrame:
    """0..n-1 split into ``partitions`` tasks; nothing is built on the driver."""
    return spark.range(0, n, 1, partitions)


def even_grid(
    df: DataFrame,
    column: str,
    points: int = 100,
    *,
    pad_share: float = 0.0,
    pad_abs: float = 0.0,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """``points`` evenly spaced values from min to max of ``column`` (per key).

    The ends are widened by ``pad_share`` of the spread and by ``pad_abs``.
    The data is reduced to one row per key first; the grid is exploded from
    that row, so the input is read once.
    """
    c = F.col(column).cast("double")
    ends = df.groupBy(*keys).agg(F.min(c).alias("_lo"), F.max(c).alias("_hi"))
    pad = (F.col("_hi") - F.col("_lo")) * F.lit(pad_share) + F.lit(pad_abs)
    ends = ends.select(*keys, (F.col("_lo") - pad).alias("_lo"), (F.col("_hi") + pad).alias("_hi"))
    step = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    return ends.select(*keys, "_lo", "_hi", step).select(
        *keys,
        "point",
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("point") / F.lit(points - 1)).alias(column),
    )
