"""Averaged perceptron against a sequential one, penalised logit against MLlib."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from quern.models import perceptron as pc
from quern.operators import irls


def made(n=120, features=12, classes=2, seed=3):
    draw = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        label = int(draw.integers(classes))
        places = sorted(set(draw.choice(features, 4).tolist()) | {label})
        rows.append((k, label, places, [int(draw.integers(1, 4)) for _ in places]))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "key long, class int, features array<int>, values array<int>")


def sequential(rows, features, classes, epochs, rate, l2, seed):
    """The plain algorithm, a row at a time, dense."""
    outputs = 1 if classes == 2 else classes
    w, b, sw, sb, steps = np.zeros((outputs, features)), np.zeros(outputs), 0, 0, 0
    for epoch in range(epochs):
        for key, label, places, values in sorted(rows, key=lambda r: hashlib.md5(f"{r[0]}:{seed + epoch + 1}".encode()).hexdigest()):
            x = np.zeros(features)
            x[places] = values
            for o in range(outputs):
                y = 1 if (label == o if classes > 2 else label == 1) else -1
                wrong = y * (w[o] @ x + b[o]) <= 0
                w[o] *= 1 - rate * l2
                if wrong:
                    w[o] += rate * y * x
                    b[o] += rate * y
            sw, sb, steps = sw + w.copy(), sb + b.copy(), steps + 1
    return np.column_stack([sw / steps, sb / steps])


@pytest.mark.parametrize("classes", [2, 3])
def test_one_shard_is_the_sequential_perceptron(spark, classes):
    rows = made(classes=classes)
    want = sequential(rows, 12, classes, 3, 0.5, 1e-2, 7)
    for parts in (1, 6):
        got = pc.fit(frame(spark, rows).repartition(parts), F.col("key"), 12, classes, 3, 0.5, 1e-2, seed=7)
        assert got.weights == pytest.approx(want)


def test_shards_do_not_depend_on_the_layout(spark):
    rows = made(n=300)
    a, b = (pc.fit(frame(spark, rows).repartition(p), F.col("key"), 12, 2, shards=5).weights for p in (1, 16))
    assert a == pytest.approx(b) and np.abs(a - pc.fit(frame(spark, rows), F.col("key"), 12, 2).weights).max() > 1e-6
    found = pc.predicted(frame(spark, rows), pc.Perceptron(a)).collect()
    assert np.mean([r["class"] == r.prediction for r in found]) > 0.8
    assert not pc.fit(frame(spark, []), F.col("key"), 12, 2).weights.any()


def test_few_entries_are_held_at_once(spark, monkeypatch):
    """Slices of a few entries, whatever batches Spark sends: the same weights and predictions."""
    rows, lists = made(n=200), pc._lists
    plain = pc.fit(frame(spark, rows), F.col("key"), 12, 2, shards=3)
    told = pc.predicted(frame(spark, rows), plain).orderBy("key").collect()
    monkeypatch.setattr(pc, "SLICE_ENTRIES", 7)
    assert (pc.fit(frame(spark, rows).repartition(2), F.col("key"), 12, 2, shards=3).weights == plain.weights).all()
    assert pc.predicted(frame(spark, rows), plain).orderBy("key").collect() == told
    batch = pa.RecordBatch.from_pydict({"features": [[0, 3], [], [1, 2, 5, 6]], "values": [[1, 2], [], [3, 4, 5, 6]]})
    for part in (batch, batch.slice(1), batch.slice(2), batch.slice(0, 2), batch.slice(0, 0)):
        places, values = lists(part)
        assert [x.tolist() for x in places][: part.num_rows] == part.column("features").to_pylist()
        assert [x.tolist() for x in values][: part.num_rows] == part.column("values").to_pylist()


@pytest.fixture(scope="module")
def points(spark):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(400, 3)) * [1, 100, 0.01] + [5, 1e4, 0]
    p = 1 / (1 + np.exp(-((x[:, 0] - 5) - 0.01 * (x[:, 1] - 1e4) + 0.3)))
    return spark.createDataFrame([(*map(float, r), int(draw.random() < q)) for r, q in zip(x, p)], "a double, b double, c double, y int")


@pytest.mark.parametrize("penalty, share", [(0.0, 0.0), (0.1, 0.0), (0.05, 0.5), (0.02, 1.0), (5.0, 1.0)])
def test_logits_are_those_of_mllib(points, penalty, share):
    found = irls.fit(points, ["a", "b", "c"], "y", penalty, share)
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(points)
    model = LogisticRegression(labelCol="y", regParam=penalty, elasticNetParam=share, maxIter=1000, tol=1e-12).fit(vectors)
    spread = np.array([1, 100, 0.01])
    assert found.weights * spread == pytest.approx(np.array(model.coefficients) * spread, abs=1e-4)
    assert found.intercept == pytest.approx(model.intercept, abs=1e-2)
    assert all(b <= a + 1e-12 for a, b in zip(found.objective, found.objective[1:]))


def test_odd_points(spark, points):
    one = points.withColumns({"c": F.lit(2.0), "y": F.lit(1)})
    found = irls.fit(one, ["a", "c"], "y", 0.1, 0.5)
    assert found.weights.tolist() == pytest.approx([0, 0], abs=1e-6) and found.intercept > 10
    assert irls.fit(points.limit(0), ["a"], "y").intercept == 0
    with_null = points.union(spark.createDataFrame([(None, 1.0, 1.0, 1)], points.schema))
    assert irls.fit(with_null, ["a"], "y").weights == pytest.approx(irls.fit(points, ["a"], "y").weights)
