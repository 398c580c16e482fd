"""Numeric expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def powers(x: Column, degree: int) -> list[Column]:
    """x, x², ... up to ``degree``."""
    out = [x]
    for _ in range(degree - 1):
        out.append(out[-1] * x)
    return out


def fourier_pairs(t: Column, periods: list[int]) -> dict[str, Column]:
    """``sin_k`` and ``cos_k`` of ``2*pi*t/k`` for every period k."""
    out = {}
    for k in periods:
        angle = F.lit(2 * math.pi) * t / F.lit(float(k))
        out[f"sin_{k}"] = F.sin(angle)
        out[f"cos_{k}"] = F.cos(angle)
    return out


def linear_score(weights: dict[str, float], intercept: float) -> Column:
    """``sum(weight * column) + intercept``."""
    score = F.lit(float(intercept))
    for column, weight in weights.items():
        score = score + F.lit(float(weight)) * F.col(column)
    return score


def logistic(z: Column) -> Column:
    """P(1) for a logit."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def odds_ratio(coefficient: Column) -> Column:
    return F.exp(coefficient)


def odds_percent(coefficient: Column) -> Column:
    """Change of the odds in percent when the feature grows by one."""
    return (F.exp(coefficient) - 1) * 100


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are present; null if one is constant."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    varied = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return F.when(varied, F.covar_pop(x, y) / (F.stddev_pop(x) * F.stddev_pop(y)))


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / F.nullif(whole, F.lit(0)))


def in_circle(x: Column, y: Column, closed: bool = False) -> Column:
    """1 when (x, y) is inside the unit circle; ``closed`` counts its edge too."""
    r2 = x * x + y * y
    inside = r2 <= 1 if closed else r2 < 1
    return F.when(inside, 1).otherwise(0)
