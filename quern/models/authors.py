"""Text classifiers on bags of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import WORD_GAPS
from quern.operators import words as wd
from quern.operators.metrics import class_summary, confusion, per_class
from quern.operators.words import vocabulary


def tokenizer(text: str, out: str = "words") -> RegexTokenizer:
    return RegexTokenizer(inputCol=text, outputCol=out, pattern=WORD_GAPS)


def label_indexer(label: str, out: str = "label", *, alphabetical: bool = False) -> StringIndexer:
    """Most frequent class first (equal ones by name), or by name only."""
    order = "alphabetAsc" if alphabetical else "frequencyDesc"
    return StringIndexer(inputCol=label, outputCol=out, stringOrderType=order)


def bag_pipeline(text: str, label: str, classifier: Estimator, *, vocab_size: int = 10_000, min_df: int = 2) -> Pipeline:
    """Tokens, counts, label index, classifier."""
    return Pipeline(
        stages=[
            tokenizer(text),
            CountVectorizer(inputCol="words", outputCol="features", vocabSize=vocab_size, minDF=min_df),
            label_indexer(label),
            classifier,
        ]
    )


def fixed_bag(df: DataFrame, words: Column, size: int = 10_000, min_df: int = 2) -> CountVectorizerModel:
    """Count vectors over a vocabulary whose ties are broken by word, so that it is the same in every run.

    The ``size`` words come to the driver; they are the vocabulary every task needs.
    """
    terms = [r.word for r in vocabulary(df, words, size, min_df).select("word").collect()]
    return CountVectorizerModel.from_vocabulary(terms, inputCol="words", outputCol="features")


class TopTerms(Estimator):
    """CountVectorizer for rows of ``words.coded`` (``features`` and ``values``, places of terms and counts).

    Learns the ``size`` most frequent terms found in at least ``min_df`` rows; equal counts go by place. Words are cut and
    looked up once for all fits, so that a fit reads numbers only.
    """

    def __init__(self, size: int = 10_000, min_df: int = 2):
        super().__init__()
        self.size, self.min_df = size, min_df

    def _fit(self, dataset: DataFrame) -> TermVectors:
        counts = (
            dataset.select(F.inline(F.arrays_zip("features", "values")))
            .groupBy("features")
            .agg(F.sum("values").alias("n"), F.count("*").alias("df"))
        )
        top = counts.where(F.col("df") >= self.min_df).orderBy(F.desc("n"), "features").limit(self.size)
        places = sorted(r.features for r in top.select("features").collect())
        if not places:
            raise ValueError("The vocabulary size should be > 0. Lower min_df as necessary.")
        return TermVectors(places)


class TermVectors(Transformer):
    """Turns ``features`` and ``values`` into the sparse vector ``features`` over some terms; other terms are passed over."""

    def __init__(self, places: list[int]):
        super().__init__()
        self.places = places

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rest = dataset.drop("features", "values")
        schema = T.StructType([*rest.schema, T.StructField("features", VectorUDT())])
        keep, size, most = rest.columns, len(self.places), wd.SLICE_WORDS
        number = np.full(self.places[-1] + 2, -1, np.int32)
        number[self.places] = np.arange(size)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, lengths in wd.slices(batches, "features", most):
                place = batch.column("features").flatten().to_numpy()
                found = number[np.minimum(place, len(number) - 1)]
                known = found >= 0
                ends = np.concatenate([[0], np.cumsum(known)])[np.concatenate([[0], np.cumsum(lengths)])]
                values = batch.column("values").flatten().to_numpy()[known].astype(np.float64)
                lists = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(x)) for x in (found[known], values)]
                fixed = [pa.array(np.full(batch.num_rows, x, kind)) for x, kind in ((0, np.int8), (size, np.int32))]
                vector = pa.StructArray.from_arrays([*fixed, *lists], names=["type", "size", "indices", "values"])
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), vector], names=schema.names)

        return dataset.select(*keep, "features", "values").mapInArrow(run, schema)


def tree(depth: int = 30, impurity: str = "gini") -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol="label", featuresCol="features", impurity=impurity, maxDepth=depth)


def naive_bayes(smoothing: float = 0.2, model_type: str = "multinomial") -> NaiveBayes:
    return NaiveBayes(labelCol="label", featuresCol="features", smoothing=smoothing, modelType=model_type)


def importances(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``word, importance`` rows, the most important word first, without zeros."""
    bag = next(s for s in model.stages if isinstance(s, CountVectorizerModel))
    weights = model.stages[-1].featureImportances
    rows = [(bag.vocabulary[int(i)], float(v)) for i, v in zip(weights.indices, weights.values) if v > 0]
    out = df.sparkSession.createDataFrame(rows, "word STRING, importance DOUBLE")
    return out.orderBy(F.desc("importance"), "word")


def metrics_row(name: str, model: PipelineModel, test: DataFrame) -> DataFrame:
    """Accuracy, weighted precision and recall and F1 of one data set, from one confusion table."""
    found = model.transform(test)
    row = class_summary(per_class(confusion(found, "label", "prediction")))
    return row.select(
        F.lit(name).alias("Filename"),
        F.col("accuracy").alias("Accuracy"),
        F.col("weighted_precision").alias("Weighted Precision"),
        F.col("weighted_recall").alias("Weighted Recall"),
        F.col("weighted_f1").alias("F1 Score"),
    )


def named_predictions(df: DataFrame, labels: list[str], out: str = "predicted") -> DataFrame:
    """Class names for the predicted indices."""
    return IndexToString(inputCol="prediction", outputCol=out, labels=labels).transform(df)
