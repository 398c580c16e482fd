"""Histograms and correlations as plain aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.maths import safe_corr


def bin_number(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1; the last bin includes its upper end, one value means bin 0."""
    width = (hi - lo) / F.lit(float(bins))
    place = F.floor((x - lo) / F.nullif(width, F.lit(0.0)))
    return F.when(hi == lo, F.lit(0)).otherwise(F.least(place, F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, column: str, bins: int, weight: str | None = None) -> DataFrame:
    """``bin, lo, hi, count`` (and ``weight``) over the non-null values; lo and hi are the data's ends."""
    values = df.where(F.col(column).isNotNull()).withColumn("_x", F.col(column).cast("double"))
    ends = values.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi")).alias("ends"))
    placed = values.withColumn("_ends", ends.scalar())
    lo, hi = F.col("_ends.lo"), F.col("_ends.hi")
    totals = [F.count("*").alias("count")]
    if weight:
        totals.append(F.sum(weight).alias("weight"))
    return placed.groupBy(
        bin_number(F.col("_x"), lo, hi, bins).alias("bin"), lo.alias("lo"), hi.alias("hi")
    ).agg(*totals)


def histograms(df: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """Histograms of several numeric columns in two passes over the data, whatever their number."""
    long = df.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]
            )
        ).alias("v")
    ).select("v.column", "v.x")
    long = long.where(F.col("x").isNotNull())
    ends = df.agg(
        F.map_from_entries(
            F.array(
                *[
                    F.struct(
                        F.lit(c),
                        F.struct(
                            F.min(F.col(c).cast("double")).alias("lo"),
                            F.max(F.col(c).cast("double")).alias("hi"),
                        ),
                    )
                    for c in columns
                ]
            )
        ).alias("ends")
    )
    placed = long.withColumn("_e", ends.scalar()[F.col("column")])
    lo, hi = F.col("_e.lo"), F.col("_e.hi")
    return placed.groupBy(
        "column", bin_number(F.col("x"), lo, hi, bins).alias("bin"), lo.alias("lo"), hi.alias("hi")
    ).agg(F.count("*").alias("count"))


def correlations(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target: one aggregate, one row per column."""
    wide = df.agg(*[safe_corr(F.col(c), F.col(target)).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("r")) for c in columns])
    return wide.select(F.explode(pairs).alias("p")).select("p.column", "p.r")
