"""Grid search with k-fold cross-validation, reported as tables."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame


def grid(options: list[tuple]) -> list[dict]:
    """``(param, values)`` pairs to the parameter maps of their combinations."""
    builder = ParamGridBuilder()
    for param, values in options:
        builder = builder.addGrid(param, values)
    return builder.build()


def cross_validate(
    estimator: Estimator,
    maps: list[dict],
    evaluator: Evaluator,
    df: DataFrame,
    *,
    folds: int = 3,
    parallelism: int = 8,
    fold_col: str = "",
    seed: int = 42,
) -> CrossValidatorModel:
    """``fold_col`` (0..folds-1) fixes the folds; otherwise Spark draws them by seed.

    The validator caches its training and test rows itself; ``df`` should be
    cheap to read, such as a staged table.
    """
    cv = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=maps,
        evaluator=evaluator,
        numFolds=folds,
        parallelism=parallelism,
        seed=seed,
        foldCol=fold_col,
    )
    return cv.fit(df)


def grid_table(df: DataFrame, model: CrossValidatorModel, maps: list[dict]) -> DataFrame:
    """``params, mean, stddev, best``: the mean metric of every grid point over the folds."""
    spread = model.stdMetrics or [0.0] * len(maps)
    pick = max if model.getEvaluator().isLargerBetter() else min
    best = pick(model.avgMetrics)
    rows = [
        (", ".join(sorted(f"{p.name}={v}" for p, v in m.items())), float(a), float(s), bool(a == best))
        for m, a, s in zip(maps, model.avgMetrics, spread, strict=True)
    ]
    return df.sparkSession.createDataFrame(rows, "params STRING, mean DOUBLE, stddev DOUBLE, best BOOLEAN")
