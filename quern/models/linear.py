"""Linear regression pipelines and their reports as tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def linear(label: str, features: str = "features", **params) -> LinearRegression:
    """``params``: maxIter, regParam, elasticNetParam, solver."""
    return LinearRegression(labelCol=label, featuresCol=features, **params)


def line_pipeline(columns: list[str], label: str, **params) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features"), linear(label, **params)])


def polynomial_pipeline(columns: list[str], label: str, degree: int, **params) -> Pipeline:
    """All products of the columns up to ``degree``."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=columns, outputCol="features"),
            PolynomialExpansion(degree=degree, inputCol="features", outputCol="poly_features"),
            linear(label, "poly_features", **params),
        ]
    )


def periodic_pipeline(t: str, periodic: list[str], label: str, degree: int, **params) -> Pipeline:
    """A polynomial of ``t`` next to sine and cosine columns."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=[t], outputCol="features"),
            PolynomialExpansion(degree=degree, inputCol="features", outputCol="features_poly"),
            VectorAssembler(inputCols=[*periodic, "features_poly"], outputCol="features_merged"),
            linear(label, "features_merged", **params),
        ]
    )


def fitted(model: PipelineModel) -> LinearRegressionModel:
    return model.stages[-1]


def fit_report(spark: SparkSession, name: str, model: PipelineModel) -> DataFrame:
    """One row: iterations, MSE, RMSE, MAE and r2 of the training rows."""
    s = fitted(model).summary
    row = (
        name, int(s.totalIterations), float(s.meanSquaredError), float(s.rootMeanSquaredError),
        float(s.meanAbsoluteError), float(s.r2),
    )
    return spark.createDataFrame(
        [row], "model STRING, iterations INT, mse DOUBLE, rmse DOUBLE, mae DOUBLE, r2 DOUBLE"
    )


def coefficients(spark: SparkSession, model: PipelineModel, names: list[str] | None = None) -> DataFrame:
    """``term, coefficient`` rows with the intercept."""
    line = fitted(model)
    values = [float(v) for v in line.coefficients]
    terms = names or [f"f{i}" for i in range(len(values))]
    return spark.createDataFrame(
        [*zip(terms, values, strict=True), ("intercept", float(line.intercept))], "term STRING, coefficient DOUBLE"
    )


def objective_history(spark: SparkSession, summary) -> DataFrame:
    """``iteration, objective`` rows of a training summary."""
    rows = [(i, float(v)) for i, v in enumerate(summary.objectiveHistory)]
    return spark.createDataFrame(rows, "iteration INT, objective DOUBLE")


def ols_summary(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """``term, coefficient, se, t, p`` of an unregularised fit by normal equations."""
    model = line_pipeline(columns, label, solver="normal", regParam=0.0).fit(df)
    line = fitted(model)
    s = line.summary
    values = [*(float(v) for v in line.coefficients), float(line.intercept)]
    rows = [
        (term, value, float(se), float(t), float(p))
        for term, value, se, t, p in zip(
            [*columns, "intercept"], values, s.coefficientStandardErrors, s.tValues, s.pValues, strict=True
        )
    ]
    return df.sparkSession.createDataFrame(rows, "term STRING, coefficient DOUBLE, se DOUBLE, t DOUBLE, p DOUBLE")


def predictions(model: PipelineModel, df: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns with the prediction."""
    return model.transform(df).select(*columns, F.col("prediction"))
