"""Equi-join that spreads known hot keys over several tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(counts: DataFrame, on: list[str], n: str) -> DataFrame:
    """``on`` and ``salts`` of the keys that would fill more than an eighth of a shuffle partition.

    ``counts`` has one row per key with the number ``n`` of rows to expect. A key gets four tasks for each partition's
    share of all rows that it holds, two at least. There are at most eight keys per shuffle partition.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum(n).alias("n")).scalar()
    share = F.col(n) * F.lit(partitions) / total
    salts = F.greatest(F.lit(2), F.ceil(share * 4)).cast("int")
    return counts.where(share * 8 > 1).select(*on, salts.alias("salts"))


def salted_join(big: DataFrame, small: DataFrame, on: list[str], hot: DataFrame, spread: Column) -> DataFrame:
    """Inner join where rows of ``big`` with a hot key are dealt to several tasks.

    ``small`` has at most one row per key. ``hot`` (see ``hot_keys``) has a bounded number of rows and is broadcast.
    ``spread`` is any column of ``big`` that varies within a hot key.
    """
    flags = F.broadcast(hot.select(*on, F.col("salts").alias("_salts")))
    salt = F.when(F.col("_salts") > 0, F.pmod(F.hash(spread), F.col("_salts"))).otherwise(F.lit(0))
    copies = F.when(F.col("_salts") > 0, F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(F.array(F.lit(0)))
    dealt = big.join(flags, on, "left").withColumn("_salt", salt).drop("_salts")
    copied = small.join(flags, on, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return dealt.join(copied, [*on, "_salt"]).drop("_salt")
