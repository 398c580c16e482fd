"""Tree regressors and side-by-side evaluation."""

from __future__ import annotations

from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.metrics import regression_metrics
from quern.operators.relational import all_but, union_all
from quern.sources.staging import staged


# The settings of the compared regressors.
LINE = {"maxIter": 100, "regParam": 0.1, "elasticNetParam": 0.8}
TREE = {"maxDepth": 10, "minInstancesPerNode": 5}
FOREST = {"numTrees": 100, "maxDepth": 10, "subsamplingRate": 0.8, "seed": 42}
BOOSTED = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "seed": 42}


def columns(label: str) -> dict[str, str]:
    return {"labelCol": label, "featuresCol": "features"}


def decision_tree(label: str, **settings) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(**columns(label), **(settings or TREE))


def random_forest(label: str) -> RandomForestRegressor:
    return RandomForestRegressor(**columns(label), **FOREST)


def boosted_trees(label: str) -> GBTRegressor:
    return GBTRegressor(**columns(label), **BOOSTED)


def standard_set(label: str) -> dict[str, Estimator]:
    return {
        "linear": LinearRegression(**columns(label), **LINE),
        "decision_tree": decision_tree(label),
        "random_forest": random_forest(label),
        "boosted_trees": boosted_trees(label),
    }


def assemble(df: DataFrame, label: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """label, kept columns and the vector of all others."""
    columns = all_but(df, label, *keep)
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(df)
    return vectors.select(label, *keep, "features")


def both_metrics(model: Transformer, parts: DataFrame, label: str, part: str = "part") -> DataFrame:
    """Metrics per part ('train', 'test') in one aggregate over the scored rows."""
    return regression_metrics(model.transform(parts), label, "prediction", keys=(part,))


def compare(parts: DataFrame, label: str, models: dict[str, Estimator], part: str = "part") -> DataFrame:
    """Train every model on part 'train' and put its metrics on all parts under each other.

    ``parts`` has label, part and ``features``; it is written once for all fits and evaluations.
    """
    parts = staged(parts, "model-parts")
    training = parts.where(F.col(part) == "train")
    tables = [
        both_metrics(estimator.fit(training), parts, label, part).select(F.lit(name).alias("model"), "*")
        for name, estimator in models.items()
    ]
    return union_all(tables)
