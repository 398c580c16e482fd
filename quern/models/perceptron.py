"""Averaged perceptron over all rows, by mixing of weights.

Rows are dealt to shards by a hash of their key. In an epoch every shard runs the perceptron over its rows, one after the
other in an order drawn by hash, from the weights that all shared; the shards' weights are then mixed by their numbers of
rows. The result is the mean of the weights after all steps of all epochs. A task streams its shard: it holds the weights,
not the rows. One shard is the sequential perceptron.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import hashing as hs
from quern.models.histogram_trees import _slices

ROWS_PER_SHARD = 200_000
# Entries (a row's features) that a task holds as arrays of its own; a single row may have more.
SLICE_ENTRIES = 1 << 18
ROW = ("class", "features", "values")
SUMS = "output int, place int, total double, last double"


@dataclass
class Perceptron:
    """``weights``: one row per class with a last column for the bias; one row alone tells class 1 from class 0."""

    weights: np.ndarray

    def margins(self, features: np.ndarray, values: np.ndarray) -> np.ndarray:
        return self.weights[:, features] @ values + self.weights[:, -1]


def _step(weights: np.ndarray, label: int, features: np.ndarray, values: np.ndarray, rate: float, l2: float) -> None:
    """One row: weights shrink by the penalty, and outputs on the wrong side move by the row. The bias is not shrunk."""
    outputs = len(weights)
    side = np.where(np.arange(outputs) == label, 1.0, -1.0) if outputs > 1 else np.array([1.0 if label == 1 else -1.0])
    wrong = side * (weights[:, features] @ values + weights[:, -1]) <= 0
    weights[:, :-1] *= 1 - rate * l2
    push = rate * side * wrong
    weights[:, features] += push[:, None] * values[None, :]
    weights[:, -1] += push


def _lists(batch: pa.RecordBatch) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Places and values of each row."""
    ends = np.cumsum(np.diff(batch.column("features").offsets.to_numpy()))[:-1]
    return np.split(batch.column("features").flatten().to_numpy(), ends), np.split(batch.column("values").flatten().to_numpy().astype(float), ends)


def fit(rows: DataFrame, key: Column, features: int, classes: int, epochs: int = 5, rate: float = 1.0, l2: float = 1e-3, shards: int | None = None, seed: int = 0) -> Perceptron:
    """``rows``: class (0 to ``classes`` - 1), features and values (ascending places below ``features``, counts); written.

    ``key`` is unique per row: shards and order hang on it, not on the layout. ``shards`` defaults to one for every
    ROWS_PER_SHARD rows. On the driver are the weights, classes x features. No rows give weights of 0.
    """
    outputs = 1 if classes <= 2 else classes
    count = rows.count()
    shards = shards or max(1, math.ceil(count / ROWS_PER_SHARD))
    dealt = rows.select(*ROW, hs.hash_bucket(key, seed, shards).alias("shard"), key.cast("string").alias("key"))
    weights, total, most = np.zeros((outputs, features + 1)), np.zeros((outputs, features + 1)), SLICE_ENTRIES

    for epoch in range(epochs if count else 0):
        sent = rows.sparkSession.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            shard, now, summed, steps = None, None, None, 0

            def told() -> pa.RecordBatch:
                at = np.nonzero((summed != 0) | (now != 0))
                arrays = [pa.array(np.append(at[0], -1).astype(np.int32)), pa.array(np.append(at[1], 0).astype(np.int32))]
                arrays += [pa.array(np.append(summed[at], steps)), pa.array(np.append(now[at] * steps, 0.0))]
                return pa.RecordBatch.from_arrays(arrays, names=["output", "place", "total", "last"])

            for batch in _slices(batches, most):
                for mine, label, places, values in zip(batch.column("shard").to_pylist(), batch.column("class").to_pylist(), *_lists(batch), strict=True):
                    if mine != shard:
                        if steps:
                            yield told()
                        shard, now, steps = mine, sent.value.copy(), 0
                        summed = np.zeros_like(now)
                    _step(now, label, places, values, rate, l2)
                    summed += now
                    steps += 1
            if steps:
                yield told()

        ordered = dealt.repartition(shards, "shard").sortWithinPartitions("shard", hs.keyed_md5(F.col("key"), seed + epoch + 1))
        mixed = ordered.select(*ROW, "shard").mapInArrow(run, SUMS).groupBy("output", "place").agg(F.sum("total").alias("total"), F.sum("last").alias("last"))
        weights = np.zeros_like(weights)
        for r in mixed.collect():
            if r["output"] >= 0:
                total[r["output"], r["place"]] += r["total"]
                weights[r["output"], r["place"]] = r["last"] / count
    return Perceptron(total / max(1, count * epochs))


def predicted(rows: DataFrame, model: Perceptron, name: str = "prediction") -> DataFrame:
    """``rows`` without ROW's features, with the class told: the largest margin, the first of equal ones."""
    keep = [c for c in rows.columns if c not in ROW[1:]]
    sent, most = rows.sparkSession.sparkContext.broadcast(model), SLICE_ENTRIES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in _slices(batches, most):
            found = []
            for places, values in zip(*_lists(batch), strict=True):
                margins = known.margins(places, values)
                found.append(int(margins.argmax()) if len(margins) > 1 else int(margins[0] > 0))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found, pa.int32())], names=[*keep, name])

    return rows.select(*keep, *ROW[1:]).mapInArrow(run, T.StructType([*(rows.schema[c] for c in keep), T.StructField(name, T.IntegerType())]))
