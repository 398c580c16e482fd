"""Repeatable samples, splits, shuffles and folds.

All of them depend only on a row's key and a seed, never on how the data is
laid out, so a recomputed task draws the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import hashing as hs
from quern.operators.prefix import SLOT, cut_values, default_slots, positions, quantile_slots, tile_ends, with_block

def sample(df: DataFrame, key: str, per_mille: int, seed: int) -> DataFrame:
    """About ``per_mille`` of 1000 rows, each kept or not by its own hash."""
    return df.where(hs.hash_bucket(F.col(key), seed, 1000) < per_mille)


def split_column(key: str, weights: dict[str, float], seed: int) -> Column:
    """Name of the part a row belongs to; weights need not sum to one."""
    total = sum(weights.values())
    unit = hs.hash_unit(F.col(key), seed)
    upto, out, names = 0.0, None, list(weights)
    for name in names[:-1]:
        upto += weights[name] / total
        out = F.when(unit < upto, name) if out is None else out.when(unit < upto, name)
    return F.lit(names[-1]) if out is None else out.otherwise(F.lit(names[-1]))


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Spark's own split, sampled per partition; its parts depend on the data layout."""
    return df.randomSplit(weights, seed)


def _hash_slots(df: DataFrame, key: str, seed: int) -> DataFrame:
    """``_hash``, whose text order is a seeded shuffle, and slots by as many of its digits as the default slots need."""
    digits = math.ceil(math.log(default_slots(df.sparkSession), 16))
    hashed = df.withColumn("_hash", hs.keyed_md5(F.col(key), seed))
    return hashed.withColumn(SLOT, hs.hash_slot(F.col("_hash"), digits))


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Add ``shuffle_pos``, the 1-based place in a seeded shuffle."""
    marked = _hash_slots(df, key, seed)
    return positions(marked, "_hash", slot=F.col(SLOT), name="shuffle_pos").drop("_hash")


def head_split(df: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """Add ``part``: the first ``share`` of a seeded shuffle is 'train' (exact count), the rest 'test'."""
    marked = _hash_slots(df, key, seed)
    last = lambda total: F.array(F.floor(total * F.lit(share)))
    cut = cut_values(marked, "_hash", (), last).select(F.col("_cuts")[0].alias("cut")).scalar()
    inside = F.coalesce(hs.keyed_md5(F.col(key), seed) <= cut, F.lit(False))
    return df.withColumn("part", F.when(inside, "train").otherwise("test"))


def plain_folds(df: DataFrame, key: str, k: int) -> DataFrame:
    """Add ``fold`` 1..k: contiguous blocks in the order of a unique numeric key."""
    return with_block(df, quantile_slots(df, key), key, (), lambda total: tile_ends(total, k), "fold")


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed: int) -> DataFrame:
    """Add ``fold`` 1..k so that every class is spread evenly (sizes differ by at most one)."""
    marked = _hash_slots(df, key, seed)
    return with_block(marked.drop(SLOT), marked, "_hash", (label,), lambda total: tile_ends(total, k), "fold").drop("_hash")


def ordered_stratified_folds(df: DataFrame, key: str, label: str, k: int) -> DataFrame:
    """The unshuffled variant: blocks of each class in the order of a unique numeric key."""
    return with_block(df, quantile_slots(df, key), key, (label,), lambda total: tile_ends(total, k), "fold")


def skip_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """All rows after the first ``n`` in the order of a unique key: a bounded heap finds the last row to skip."""
    if n < 1:
        return df
    last = df.select(F.col(key).alias("k")).orderBy("k").limit(n).agg(F.max("k").alias("k")).scalar()
    return df.where(F.col(key) > last)
