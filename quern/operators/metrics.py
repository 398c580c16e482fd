"""Evaluation tables from labels, predictions and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.maths import safe_ratio
from quern.operators.prefix import running_totals
from quern.sources.staging import staged


def confusion(df: DataFrame, label: str, prediction: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Counts per label and prediction (and keys): the one pass all class metrics come from."""
    return df.groupBy(*keys, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("count")
    )


def per_class(counts: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Precision, recall and F1 of every class, from a confusion table."""
    n, zero = F.col("count"), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("class"), n.alias("support"), zero.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("class"), zero.alias("support"), n.alias("predicted"), zero.alias("tp")),
    )
    sums = (
        counts.select(*keys, F.inline(sides))
        .groupBy(*keys, "class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    )
    precision = safe_ratio(F.col("tp"), F.col("predicted"))
    recall = safe_ratio(F.col("tp"), F.col("support"))
    return sums.select(
        *keys,
        "class",
        "support",
        "predicted",
        "tp",
        precision.alias("precision"),
        recall.alias("recall"),
        safe_ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
    )


def class_summary(classes: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Accuracy, weighted and macro metrics: one row (per key) from the per-class table."""
    total = F.nullif(F.sum("support"), F.lit(0))
    return classes.groupBy(*keys).agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("support") * F.col("precision")) / total).alias("weighted_precision"),
        (F.sum(F.col("support") * F.col("recall")) / total).alias("weighted_recall"),
        (F.sum(F.col("support") * F.col("f1")) / total).alias("weighted_f1"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
    )


def binary_rates(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """tp, fp, tn, fn, TPR and FPR with 1 as the positive class, in one aggregate."""

    def cell(y: int, p: int):
        return F.count_if((F.col(label) == y) & (F.col(prediction) == p))

    counts = df.agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(0, 0).alias("tn"), cell(1, 0).alias("fn")
    )
    return counts.select(
        "*",
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("tpr"),
        safe_ratio(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr"),
    )


def threshold_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """``threshold, pos, neg, tp, fp``: rows scored at least ``threshold``, per distinct score.

    Equal scores are one row. The running sums go over slots of the score, so
    any number of distinct scores works.
    """
    per_score = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum((1 - F.col(label)).cast("bigint")).alias("neg"),
    )
    per_score = staged(per_score, "score-counts")
    return running_totals(per_score, "threshold", {"pos": "tp", "neg": "fp"}, descending=True)


def _with_class_sizes(counts: DataFrame) -> DataFrame:
    sizes = counts.agg(
        F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).alias("sizes")
    ).scalar()
    return counts.withColumn("_sizes", sizes)


def roc(counts: DataFrame) -> DataFrame:
    """FPR and TPR points from (0, 0) to (1, 1), one per distinct score."""
    sized = _with_class_sizes(counts)
    points = sized.select(
        safe_ratio(F.col("fp"), F.col("_sizes.neg")).alias("FPR"),
        safe_ratio(F.col("tp"), F.col("_sizes.pos")).alias("TPR"),
    )
    start = counts.sparkSession.createDataFrame([(0.0, 0.0)], "FPR DOUBLE, TPR DOUBLE")
    return start.unionByName(points)


def area_under_roc(counts: DataFrame) -> DataFrame:
    """Trapezoid area: each score adds its negatives times the mean height of its step."""
    step = F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)
    return counts.agg(
        (F.sum(step) / F.nullif(F.sum("pos").cast("double") * F.sum("neg"), F.lit(0.0))).alias("auc")
    )


def f_by_threshold(counts: DataFrame, beta: float = 1.0) -> DataFrame:
    """``threshold`` and ``F-Measure`` of calling everything from the threshold on positive."""
    sized = _with_class_sizes(counts)
    b2 = beta * beta
    f = (1 + b2) * F.col("tp") / (F.col("tp") + F.col("fp") + b2 * F.col("_sizes.pos"))
    return sized.select("threshold", f.alias("F-Measure"))


def best_threshold(measures: DataFrame) -> DataFrame:
    """The threshold of the highest F; the lowest one among equals."""
    return measures.orderBy(F.desc("F-Measure"), "threshold").limit(1)


def regression_metrics(df: DataFrame, label: str, prediction: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """n, r2, rmse, mse and mae in one aggregate (per key)."""
    y, error = F.col(label).cast("double"), F.col(label) - F.col(prediction)
    sums = df.where(y.isNotNull() & F.col(prediction).isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("_variance"),
    )
    return sums.select(
        *keys,
        "n",
        (1 - F.col("mse") / F.nullif(F.col("_variance"), F.lit(0.0))).alias("r2"),
        F.sqrt("mse").alias("rmse"),
        "mse",
        "mae",
    )
