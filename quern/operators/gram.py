"""Linear models from moments: one aggregate over the rows, then work on small matrices.

Means, variances and covariances of the features and the label are one row per group, whatever the number of rows. Every
elastic-net fit, every fold of a cross-validation and every r2 or mean squared error follows from such rows, so a grid
of settings costs no pass of its own. The driver holds (columns + 1)^2 numbers per group.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.maths import linear_score

SMALLEST_SPREAD = 1e-9
TOLERANCE = 1e-12


@dataclass
class Moments:
    """``mean`` and ``cov`` (population) of the columns, the label last, over ``n`` rows."""

    columns: list[str]
    n: int
    mean: np.ndarray
    cov: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n, apart = self.n + other.n, other.mean - self.mean
        mean = self.mean + apart * (other.n / n)
        cov = (self.cov * self.n + other.cov * other.n + np.outer(apart, apart) * (self.n * other.n / n)) / n
        return Moments(self.columns, n, mean, cov)


@dataclass
class Line:
    """A fitted line; ``objective`` has its value before the first sweep and after each."""

    columns: list[str]
    weights: np.ndarray
    intercept: float
    sweeps: int
    objective: list[float] = field(default_factory=list)

    def score(self) -> Column:
        return linear_score(dict(zip(self.columns, self.weights.tolist(), strict=True)), self.intercept)

    def mean_squared_error(self, of: Moments) -> float:
        """Over the rows that the moments stand for."""
        w = np.append(-self.weights, 1.0)
        return float(w @ of.cov @ w + (w @ of.mean - self.intercept) ** 2)

    def r2(self, of: Moments) -> float:
        return 1 - self.mean_squared_error(of) / float(of.cov[-1, -1])


def moments(df: DataFrame, columns: list[str], label: str, key: str | None = None) -> dict:
    """Moments per value of ``key`` (None: of all rows), from one aggregate; rows with a null are left out."""
    names = [*columns, label]
    rows = df.select(*([key] if key else []), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)]).dropna(subset=[f"c{i}" for i in range(len(names))])
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    told = rows.groupBy(*([key] if key else [])).agg(
        F.count("*").alias("n"), *[F.avg(f"c{i}").alias(f"m{i}") for i in range(len(names))], *[F.covar_pop(f"c{i}", f"c{j}").alias(f"v{i}_{j}") for i, j in pairs]
    )
    out = {}
    for r in told.collect():
        cov = np.zeros((len(names), len(names)))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = r[f"v{i}_{j}"] or 0.0
        out[r[key] if key else None] = Moments(columns, r["n"], np.array([r[f"m{i}"] or 0.0 for i in range(len(names))]), cov)
    return out


def elastic_net(fits: list[tuple[Moments, float, float]], sweeps: int = 10_000, tolerance: float = TOLERANCE) -> list[Line]:
    """The lines of all ``fits`` (moments, penalty, share of the absolute part) by coordinate descent, side by side.

    Minimised is half the mean squared error plus penalty * (share * sum |w| + (1 - share) / 2 * sum w^2), on columns
    and label divided by their deviations and with the penalty divided by the label's. Every fit starts at 0 and ends
    when a sweep over the columns changes no weight by more than ``tolerance``, after ``sweeps`` at the latest. Columns
    that do not vary (deviation up to SMALLEST_SPREAD, or 1e-12 of the mean) get no weight.
    """
    if not fits:
        return []
    width = len(fits[0][0].columns)
    spread = np.array([np.sqrt(np.diag(m.cov)) for m, _, _ in fits]).reshape(len(fits), width + 1)
    means = np.array([m.mean for m, _, _ in fits])
    varied = spread > np.maximum(SMALLEST_SPREAD, 1e-12 * np.abs(means))
    size = np.where(varied, spread, 1.0)
    corr = np.array([m.cov for m, _, _ in fits]) / size[:, :, None] / size[:, None, :] * (varied[:, :, None] & varied[:, None, :])
    inner, toward = corr[:, :width, :width], corr[:, :width, width]
    penalty, share = np.array([p for _, p, _ in fits]) / size[:, width], np.array([s for _, _, s in fits])
    absolute, square = penalty * share, penalty * (1 - share)
    w, done, used = np.zeros((len(fits), width)), np.zeros(len(fits), bool), np.zeros(len(fits), int)

    def objective() -> np.ndarray:
        fit = 0.5 * corr[:, width, width] - (toward * w).sum(1) + 0.5 * np.einsum("fi,fij,fj->f", w, inner, w)
        return fit + absolute * np.abs(w).sum(1) + 0.5 * square * (w * w).sum(1)

    history = [objective()]
    for _ in range(sweeps):
        before = w.copy()
        for j in range(width):
            pull = toward[:, j] - (inner[:, j] * w).sum(1) + w[:, j] * inner[:, j, j]
            new = np.sign(pull) * np.maximum(np.abs(pull) - absolute, 0) / (1 + square)
            w[:, j] = np.where(done | ~varied[:, j], w[:, j], new)
        used += ~done
        history.append(objective())
        done |= np.abs(w - before).max(1, initial=0) <= tolerance
        if done.all():
            break
    real = w * size[:, width:] / size[:, :width]
    paths = np.array(history)
    return [
        Line(m.columns, real[k], float(m.mean[-1] - real[k] @ m.mean[:-1]), int(used[k]), paths[: used[k] + 1, k].tolist())
        for k, (m, _, _) in enumerate(fits)
    ]


def grid_search(folds: dict, settings: list[tuple[float, float]]) -> list[tuple[float, float, float, float]]:
    """(penalty, share, mean, deviation) of r2 over the folds: each is judged by a line from the moments of all others."""
    names = sorted(folds)
    rest = {}
    for name in names:
        others = [folds[o] for o in names if o != name]
        rest[name] = sum(others[1:], others[0])
    lines = iter(elastic_net([(rest[name], *setting) for setting in settings for name in names]))
    scores = [[next(lines).r2(folds[name]) for name in names] for _ in settings]
    return [(p, s, float(np.mean(r)), float(np.std(r))) for (p, s), r in zip(settings, scores, strict=True)]
