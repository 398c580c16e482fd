"""Feature columns as plain expressions."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.maths import fourier_pairs, powers


def with_powers(df: DataFrame, columns: list[str]) -> DataFrame:
    """``x_squared`` and ``x_cubed`` for every column, in one projection."""
    out = {}
    for c in columns:
        _, square, cube = powers(F.col(c), 3)
        out[f"{c}_squared"], out[f"{c}_cubed"] = square, cube
    return df.withColumns(out)


def polynomial(df: DataFrame, columns: list[str], degree: int) -> DataFrame:
    """All products of the columns up to ``degree``, named like ``x*x*y``."""
    out = {}
    for d in range(2, degree + 1):
        for names in combinations_with_replacement(columns, d):
            product = F.col(names[0])
            for n in names[1:]:
                product = product * F.col(n)
            out["*".join(names)] = product
    return df.withColumns(out)


def category_codes(df: DataFrame, columns: list[str]) -> dict[str, list[int]]:
    """The codes that occur in each column, ascending: they become the schema of ``one_hot``."""
    row = df.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in columns]).first()
    return {c: [int(code) for code in row[c]] for c in columns}


def one_hot(df: DataFrame, codes: dict[str, list[int]]) -> DataFrame:
    """0/1 columns ``name_code`` for each code that occurs except the last one; the source columns go away."""
    flags = [
        F.when(F.col(c) == code, 1).otherwise(0).alias(f"{c}_{code}") for c, found in codes.items() for code in found[:-1]
    ]
    return df.select(*[c for c in df.columns if c not in codes], *flags)


def with_fourier(df: DataFrame, t: str, periods: list[int]) -> DataFrame:
    """Sine and cosine columns of every period, in one projection."""
    return df.withColumns(fourier_pairs(F.col(t), periods))
