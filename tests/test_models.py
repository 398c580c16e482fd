"""MLlib pipelines on small made-up frames."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from quern.functions import text as tx
from quern.models import authors as au
from quern.models import linear as ln
from quern.models import logistic as lg
from quern.models import regressors as rs
from quern.models import tuning as tu
from quern.operators import features as ft
from quern.operators import sampling as sp
from quern.operators import words as wd
from quern.plans import JOBS
from quern.plans import models as plans
from quern.sources.ranges import even_grid


@pytest.fixture(scope="module")
def cubic(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(-5, 5, 200)
    y = (x + 4) * (x + 1) * (x - 3) + rng.normal(0, 1, 200)
    return spark.createDataFrame(
        [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id INT, X DOUBLE, Y DOUBLE"
    ).cache()


def test_polynomial_degrees(spark, cubic):
    r2 = {}
    for degree in (1, 3):
        model = ln.polynomial_pipeline(["X"], "Y", degree, maxIter=100, regParam=0.01, elasticNetParam=0.8).fit(cubic)
        r2[degree] = ln.fit_report(spark, str(degree), model).first().r2
    assert r2[3] > 0.99 > r2[1]


def test_reports(spark, cubic):
    model = ln.line_pipeline(["X"], "Y", maxIter=10, regParam=0.3, elasticNetParam=0.8).fit(cubic)
    report = ln.fit_report(spark, "line", model).first()
    assert report.rmse == pytest.approx(report.mse**0.5)
    terms = {r.term: r.coefficient for r in ln.coefficients(spark, model, ["X"]).collect()}
    assert set(terms) == {"X", "intercept"}
    history = ln.objective_history(spark, ln.fitted(model).summary).orderBy("iteration").collect()
    assert history[0].objective >= history[-1].objective
    grid = ln.predictions(model, even_grid(cubic, "X", 10), ["point", "X"])
    row = grid.orderBy("point").first()
    assert row.prediction == pytest.approx(terms["intercept"] + terms["X"] * row.X)


def test_ols_summary_has_p_values(cubic):
    rows = {r.term: r for r in ln.ols_summary(cubic, ["X"], "Y").collect()}
    assert rows["X"].t == pytest.approx(rows["X"].coefficient / rows["X"].se)
    assert 0 <= rows["X"].p <= 1


def test_periodic_pipeline_finds_a_wave(spark):
    days = spark.range(1, 400).select(
        F.col("id").alias("t"), (10 + 3 * F.sin(F.lit(2 * np.pi) * F.col("id") / 30)).alias("y")
    )
    waves = ft.with_fourier(days, "t", [7, 30])
    periodic = [c for c in waves.columns if c not in ("t", "y")]
    model = ln.periodic_pipeline("t", periodic, "y", 2, maxIter=100, regParam=0.001, elasticNetParam=0.9).fit(waves)
    assert ln.fit_report(spark, "p", model).first().r2 > 0.99


def test_compare_regressors(cubic):
    parts = cubic.withColumn("part", sp.split_column("id", {"train": 0.8, "test": 0.3}, 42)).drop("id")
    models = {"linear": rs.standard_set("Y")["linear"], "decision_tree": rs.decision_tree("Y")}
    rows = {(r.model, r.part): r for r in rs.compare(rs.assemble(parts, "Y", ("part",)), "Y", models).collect()}
    assert set(rows) == {(m, p) for m in models for p in ("train", "test")}
    assert rows[("decision_tree", "test")].r2 > rows[("linear", "test")].r2


def test_one_hot_leaves_out_the_last_code(spark):
    df = spark.createDataFrame([(1, 0), (2, 2), (3, 1)], "id INT, c INT")
    out = ft.one_hot(df, ft.category_codes(df, ["c"])).orderBy("id").collect()
    assert [(r.c_0, r.c_1) for r in out] == [(1, 0), (0, 0), (0, 1)]


def test_logistic_scores(spark):
    rows = [(i, float(i % 10), int(i % 10 > 4)) for i in range(100)]
    df = spark.createDataFrame(rows, "id INT, x DOUBLE, y INT")
    model = lg.logistic_pipeline(["x"], "y", maxIter=100, regParam=0.01).fit(df)
    scored = lg.scored(model, df, threshold=0.53).collect()
    assert all((r.p1 > 0.53) == (r.prediction == 1.0) for r in scored)
    assert all(r.prob == pytest.approx(max(r.p1, 1 - r.p1)) for r in scored)
    table = {r.term: r for r in lg.coefficient_table(spark, model).collect()}
    assert table["x"].odds_ratio == pytest.approx(np.exp(table["x"].coefficient))
    named = lg.named_result(lg.scored(model, df), "Zdał", "Nie zdał", "Wynik")
    assert {r.Wynik for r in named.select("Wynik").distinct().collect()} == {"Zdał", "Nie zdał"}


@pytest.fixture(scope="module")
def authors(spark):
    rows = [(i, "Ala" if i % 3 else "Ola", ("kot mysz " if i % 3 else "pies kość ") * 2 + f"w{i % 4}") for i in range(60)]
    return spark.createDataFrame(rows, "id INT, author STRING, content STRING").cache()


@pytest.mark.parametrize("classifier", [lambda: au.tree(5), lambda: au.naive_bayes(0.2)])
def test_author_pipelines(authors, classifier):
    model = au.bag_pipeline("content", "author", classifier()).fit(authors)
    found = au.named_predictions(model.transform(authors), model.stages[2].labels)
    assert found.where("predicted <> author").count() == 0


def test_importances_are_ranked(authors):
    model = au.bag_pipeline("content", "author", au.tree(5)).fit(authors)
    rows = au.importances(model, authors).collect()
    assert rows[0].word in {"kot", "mysz", "pies", "kość"} and all(r.importance > 0 for r in rows)


def test_fixed_bag_breaks_ties_by_word(authors):
    bag = au.fixed_bag(authors, tx.tokens(F.col("content")), 3, 1)
    assert bag.vocabulary == ["kot", "mysz", "kość"]


def test_grids(cubic, authors):
    points = rs.assemble(cubic.drop("id"), "Y")
    line = ln.linear("Y", maxIter=10)
    maps = tu.grid([(line.regParam, [0.1, 10.0]), (line.elasticNetParam, [0.0, 1.0])])
    judge = RegressionEvaluator(labelCol="Y", metricName="r2")
    table = tu.grid_table(points, tu.cross_validate(line, maps, judge, points, folds=3), maps).collect()
    assert len(table) == 4 and max(table, key=lambda r: r["mean"]).best

    rows = authors.select("id", "author", tx.tokens(F.col("content")).alias("words"))
    rows = sp.stratified_folds(rows, "id", "author", 3, 1).withColumn("fold", F.col("fold") - 1)
    bag = CountVectorizer(inputCol="words", outputCol="features")
    pipeline = Pipeline(stages=[bag, au.label_indexer("author"), au.naive_bayes()])
    maps = tu.grid([(bag.vocabSize, [1, 10])])
    fitted = tu.cross_validate(
        pipeline, maps, MulticlassClassificationEvaluator(metricName="f1"), rows, folds=3, fold_col="fold"
    )
    table = tu.grid_table(rows, fitted, maps).collect()
    assert [r.best for r in table] == [False, True] and table[1]["mean"] > 0.9


def test_linear_classifiers(spark):
    rows = [(float(i % 3), float(i % 3 == 1), float(i % 3 == 2)) for i in range(90)]
    df = spark.createDataFrame(rows, "label DOUBLE, a DOUBLE, b DOUBLE")
    vectors = rs.assemble(df, "label")
    model = lg.linear_classifier("label", 3)
    assert model.fit(vectors).transform(vectors).where("prediction <> label").count() == 0
    assert type(lg.linear_classifier("label", 2)).__name__ == "LinearSVC"


@pytest.fixture(scope="module")
def noisy(spark):
    """Words with many equal counts, ``fold`` 0..2; one row without words and one with a null."""
    rng = np.random.default_rng(3)
    rows = [(k, "ab"[k % 2], k % 3, [f"w{int(x) + 9 * (k % 2)}" for x in rng.exponential(9, 30)]) for k in range(60)]
    rows += [(60, "a", 0, []), (61, "b", 1, None)]
    return spark.createDataFrame(rows, "id INT, author STRING, fold INT, words ARRAY<STRING>").repartition(5).cache()


@pytest.mark.parametrize("most", [1 << 18, 1, 70])
def test_words_are_counted_by_part(noisy, monkeypatch, most):
    monkeypatch.setattr(wd, "SLICE_WORDS", most)
    told = noisy.select("id", "fold", F.explode("words").alias("word"))
    want = told.groupBy("fold", "word").agg(F.count("*").alias("n"), F.countDistinct("id").alias("df"))
    assert sorted(wd.counts_by_part(noisy, "words", "fold").collect()) == sorted(want.collect())


@pytest.mark.parametrize("size, min_df", [(12, 2), (25, 3), (1000, 1)])
def test_terms_of_each_training_set(noisy, monkeypatch, size, min_df):
    """Every fit on counts has the words and vectors of a CountVectorizer over that fit's own rows."""
    monkeypatch.setattr(wd, "SLICE_WORDS", 50)
    terms = [r.word for r in wd.top_words_outside(noisy, "words", "fold", 3, size, min_df).collect()]
    counts = wd.coded(noisy, "words", terms)
    union = set()
    for fold in (0, 1, 2, None):
        part = F.lit(True) if fold is None else F.col("fold") != fold
        own = sorted(r.word for r in wd.vocabulary(noisy.where(part), F.col("words"), size, min_df).collect())
        model = au.TopTerms(size, min_df).fit(counts.where(part))
        assert [terms[k] for k in model.places] == own
        want = au.CountVectorizerModel.from_vocabulary(own, inputCol="words", outputCol="features")
        want = want.transform(noisy.where("words is not null")).collect()
        got = {r.id: r.features for r in model.transform(counts).collect()}
        assert all(got[r.id] == r.features for r in want) and got[61].numNonzeros() == 0 and len(got) == 62
        union |= set(own)
    assert terms == sorted(union)


def test_no_terms(noisy):
    with pytest.raises(ValueError, match="vocabulary size"):
        au.TopTerms(10, 1000).fit(wd.coded(noisy, "words", ["w1"]))


@pytest.mark.parametrize("name", ["cv_nb", "cv_nb_fixed"])
def test_words_are_written_once_and_not_cross_validated(spark, sf_dir, monkeypatch, name):
    class Seen(Exception):
        pass

    def seen(estimator, maps, evaluator, df, **options):
        raise Seen(*df.columns)

    written, stage = [], plans.staged
    monkeypatch.setattr(plans, "staged", lambda df, label: (written.append(df.columns), stage(df, label))[1])
    monkeypatch.setattr(tu, "cross_validate", seen)
    with pytest.raises(Seen) as told:
        JOBS[name](spark, sf_dir)
    assert "words" not in told.value.args and sum("words" in columns for columns in written) == 1


def test_cv_nb_is_that_of_count_vectorizers(spark, sf_dir):
    """On the given table against MLlib's own fits, words with equal counts taken in their order."""
    rows = plans.bags(spark, sf_dir, folds=3).cache()
    judge = MulticlassClassificationEvaluator(metricName="f1")
    found = []
    for fold in range(3):
        train, test = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
        pipeline = Pipeline(stages=[au.fixed_bag(train, F.col("words")), au.label_indexer("author"), au.naive_bayes(0.2)])
        found.append(judge.evaluate(pipeline.fit(train).transform(test)))
    row = JOBS["cv_nb"](spark, sf_dir).first()
    assert (row.mean, row.stddev) == (pytest.approx(np.mean(found), abs=1e-12), pytest.approx(np.std(found), abs=1e-12))
    assert len({r.fold for r in rows.select("fold").distinct().collect()}) == 3
