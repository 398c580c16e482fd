"""Penalised logistic regression by reweighted sums: one aggregate over the rows for each step.

A step needs the gradient and the second derivatives at the weights so far, (columns + 2)^2 / 2 sums; the penalised
parabola they describe is solved on the driver by coordinate descent with a soft threshold.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.maths import linear_score, logistic
from quern.operators.gram import SMALLEST_SPREAD


@dataclass
class Logit:
    """``objective``: the penalised mean loss before each step."""

    columns: list[str]
    weights: np.ndarray
    intercept: float
    objective: list[float] = field(default_factory=list)

    def probability(self) -> Column:
        return logistic(linear_score(dict(zip(self.columns, self.weights.tolist(), strict=True)), self.intercept))


def solved(slope: np.ndarray, curve: np.ndarray, start: np.ndarray, absolute: float, square: float, sweeps: int = 1000, tolerance: float = 1e-13) -> np.ndarray:
    """Least of the parabola with this slope and curve at ``start`` plus penalties; entry 0, the intercept, has none."""
    now = start.copy()
    for _ in range(sweeps):
        before = now.copy()
        for j in range(len(now)):
            pull = curve[j, j] * now[j] - slope[j] - curve[j] @ (now - start)
            if j == 0:
                now[j] = pull / curve[j, j]
            elif curve[j, j] + square > 0:
                now[j] = np.sign(pull) * max(abs(pull) - absolute, 0) / (curve[j, j] + square)
        if np.abs(now - before).max() <= tolerance:
            break
    return now


def fit(rows: DataFrame, columns: list[str], label: str, penalty: float = 0.0, share: float = 0.0, steps: int = 25, tolerance: float = 1e-10) -> Logit:
    """Minimise mean log loss + penalty * (share * sum |w| + (1 - share) / 2 * sum w^2) for a 0/1 ``label``.

    Weights are those of columns divided by their deviations (of a sample); the result is in the columns' own units.
    Columns that do not vary get no weight, rows with a null do not count. A step that makes the objective larger is
    halved. It ends when a step moves no weight by more than ``tolerance``, after ``steps`` at the latest. One class
    alone has no finite answer: no weights, and an intercept for a share of 1e-9 or 1 - 1e-9.
    """
    names = [f"c{i}" for i in range(len(columns))]
    data = rows.select(F.col(label).cast("double").alias("y"), *[F.col(c).cast("double").alias(n) for c, n in zip(columns, names, strict=True)]).dropna()
    ends = data.agg(F.count("*").alias("n"), F.avg("y").alias("y"), *[f(n).alias(f"{n}{k}") for n in names for k, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    if not ends["n"]:
        return Logit(columns, np.zeros(len(columns)), 0.0)
    mean = np.array([ends[f"{n}m"] for n in names])
    spread = np.array([ends[f"{n}s"] or 0.0 for n in names])
    varied = spread > np.maximum(SMALLEST_SPREAD, 1e-12 * np.abs(mean))
    used = [i for i in range(len(names)) if varied[i]]
    units = [F.lit(1.0), *[(F.col(names[i]) - F.lit(float(mean[i]))) / F.lit(float(spread[i])) for i in used]]
    scaled = data.select("y", *[u.alias(f"x{k}") for k, u in enumerate(units)])
    part = min(max(ends["y"], 1e-9), 1 - 1e-9)
    now = np.zeros(len(units))
    now[0] = np.log(part / (1 - part))
    if ends["y"] != part:
        return Logit(columns, np.zeros(len(columns)), float(now[0]))
    absolute, square = penalty * share, penalty * (1 - share)
    cells = [(j, k) for j in range(len(units)) for k in range(j + 1)]
    history: list[float] = []
    best, step = now, np.zeros(len(units))
    for _ in range(steps):
        z = linear_score({f"x{k}": v for k, v in enumerate(now.tolist())}, 0.0)
        told = scaled.withColumn("z", z).withColumn("p", logistic(F.col("z")))
        q = F.col("p") * (1 - F.col("p"))
        # log(1 + e^z) - y z, without overflow.
        loss = F.greatest("z", F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("y") * F.col("z")
        sums = told.agg(
            F.avg(loss).alias("loss"), *[F.avg((F.col("p") - F.col("y")) * F.col(f"x{k}")).alias(f"g{k}") for k in range(len(units))], *[F.avg(q * F.col(f"x{j}") * F.col(f"x{k}")).alias(f"h{j}_{k}") for j, k in cells]
        ).first()
        value = sums["loss"] + absolute * np.abs(now[1:]).sum() + 0.5 * square * (now[1:] ** 2).sum()
        if history and value > history[-1] + 1e-12 and np.abs(step).max() > tolerance:
            step = step / 2
            now = best + step
            continue
        history.append(float(value))
        slope, curve = np.array([sums[f"g{k}"] for k in range(len(units))]), np.zeros((len(units), len(units)))
        for j, k in cells:
            curve[j, k] = curve[k, j] = sums[f"h{j}_{k}"]
        best = now
        step = solved(slope, curve, now, absolute, square) - now
        now = best + step
        if np.abs(step).max() <= tolerance:
            break
    weights = np.zeros(len(columns))
    weights[used] = now[1:] / spread[used]
    return Logit(columns, weights, float(now[0] - weights @ mean), history)
