"""Elastic nets from moments against MLlib, literal sums and the data itself."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from quern.operators import gram

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(300, 3)) * [1, 10, 0.1] + [0, 1e6, 3]
    y = 3 * x[:, 0] - 0.2 * x[:, 1] + 5 * x[:, 2] + draw.normal(size=300)
    return spark.createDataFrame([(*map(float, r), float(v), k % 4) for k, (r, v) in enumerate(zip(x, y))], "a double, b double, c double, y double, fold int")


@pytest.mark.parametrize("penalty, share", [(0.0, 0.0), (0.5, 0.0), (0.5, 0.4), (0.3, 1.0), (50.0, 1.0)])
def test_lines_are_those_of_mllib(rows, penalty, share):
    found = gram.elastic_net([(gram.moments(rows, NAMES, "y")[None], penalty, share)])[0]
    vectors = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    model = LinearRegression(labelCol="y", regParam=penalty, elasticNetParam=share, maxIter=500, tol=1e-12).fit(vectors)
    assert found.weights == pytest.approx(list(model.coefficients), rel=1e-4, abs=1e-6)
    assert found.intercept == pytest.approx(model.intercept, rel=1e-4)
    assert all(b <= a + 1e-12 for a, b in zip(found.objective, found.objective[1:]))


def test_moments_of_folds_add_up(rows):
    whole = gram.moments(rows, NAMES, "y")[None]
    folds = list(gram.moments(rows, NAMES, "y", "fold").values())
    total = sum(folds[1:], folds[0])
    assert total.n == whole.n == 300 and total.mean == pytest.approx(whole.mean) and total.cov == pytest.approx(whole.cov, rel=1e-9)
    data = np.array([[r.a, r.b, r.c, r.y] for r in rows.collect()])
    assert whole.cov == pytest.approx(np.cov(data.T, bias=True), rel=1e-9)


def test_scores_from_moments_are_those_of_the_rows(rows):
    found = gram.elastic_net([(gram.moments(rows.where("fold <> 1"), NAMES, "y")[None], 0.2, 0.5)])[0]
    held = rows.where("fold = 1")
    errors = held.select(F.avg(F.pow(F.col("y") - found.score(), 2)).alias("mse"), F.var_pop("y").alias("v")).first()
    told = gram.moments(held, NAMES, "y")[None]
    assert found.mean_squared_error(told) == pytest.approx(errors.mse, rel=1e-6) and found.r2(told) == pytest.approx(1 - errors.mse / errors.v, rel=1e-6)
    table = gram.grid_search(gram.moments(rows, NAMES, "y", "fold"), [(0.2, 0.5), (20.0, 0.5)])
    assert table[0][2] > table[1][2] and len(table) == 2


def test_constant_columns_and_nulls(spark):
    rows = spark.createDataFrame([(1.0, 2.0, float(k), 2.0 * k) for k in range(9)] + [(None, 1.0, 1.0, 5.0)], "a double, b double, c double, y double")
    told = gram.moments(rows, NAMES, "y")[None]
    found = gram.elastic_net([(told, 0.0, 0.0)])[0]
    assert told.n == 9 and found.weights.tolist()[:2] == [0, 0] and found.weights[2] == pytest.approx(2) and found.intercept == pytest.approx(0, abs=1e-9)
    assert gram.elastic_net([]) == []


def test_one_pass_for_a_whole_grid(spark, sf_dir, tmp_path):
    from quern.plans import JOBS

    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    JOBS["cv_grid_enet"](spark, sf_dir)
    ran = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before)
    assert len(ran) <= 10  # one query, in the jobs that its exchanges take; 175 fits
