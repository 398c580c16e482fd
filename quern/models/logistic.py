"""Binary logistic regression: fit, report, threshold, scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, LogisticRegressionModel, OneVsRest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import maths as mx
from quern.functions import vectors as vc


def logistic_pipeline(columns: list[str], label: str, **params) -> Pipeline:
    """``params``: maxIter, regParam, elasticNetParam, threshold."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=columns, outputCol="features"),
            LogisticRegression(labelCol=label, featuresCol="features", **params),
        ]
    )


def fitted(model: PipelineModel) -> LogisticRegressionModel:
    return model.stages[-1]


def coefficient_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``term, coefficient, odds_ratio, percent``: the logit as a table."""
    line = fitted(model)
    terms = [*model.stages[0].getInputCols(), "intercept"]
    values = [*(float(v) for v in line.coefficients), float(line.intercept)]
    rows = spark.createDataFrame(list(zip(terms, values, strict=True)), "term STRING, coefficient DOUBLE")
    c = F.col("coefficient")
    return rows.select("term", c, mx.odds_ratio(c).alias("odds_ratio"), mx.odds_percent(c).alias("percent"))


def scored(model: PipelineModel, df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Add ``p1``, ``prob`` (the larger probability) and ``prediction``; the vectors go away.

    ``threshold`` overrides the model's own: the class is 1 when p1 exceeds it.
    """
    out = model.transform(df).withColumns(
        {"p1": vc.element(F.col("probability"), 1), "prob": vc.max_element(F.col("probability"))}
    )
    if threshold is not None:
        out = out.withColumn("prediction", F.when(F.col("p1") > threshold, 1.0).otherwise(0.0))
    return out.drop("features", "rawPrediction", "probability")


def named_result(df: DataFrame, yes: str, no: str, name: str) -> DataFrame:
    """Replace ``prediction`` by one of two texts and drop the scores."""
    text = F.when(F.col("prediction") == 0, no).otherwise(yes)
    return df.withColumn(name, text).drop("prediction", "p1", "prob")


def linear_classifier(
    label: str, classes: int, reg: float = 1e-3, max_iter: int = 50
) -> LinearSVC | OneVsRest:
    """Linear classifier with hinge loss and l2; one per class when there are more than two."""
    svc = LinearSVC(maxIter=max_iter, regParam=reg, labelCol=label, featuresCol="features")
    if classes <= 2:
        return svc
    return OneVsRest(classifier=svc, labelCol=label, featuresCol="features", parallelism=min(classes, 8))
