"""Operators against pandas / numpy on small frames, with blocks and limits small enough to split them."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hst
from pyspark.sql import functions as F

from quern.functions import text as tx
from quern.operators import metrics as mt
from quern.operators import prefix as px
from quern.operators import profile as pf
from quern.operators import regression as rg
from quern.operators import relational as rel
from quern.operators import sampling as sp
from quern.operators import series as se
from quern.operators import skew as sk
from quern.operators import stats
from quern.operators import words as wd

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def series(spark, n=500, keys=("a",), seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for k in keys:
        y = 50 + 10 * np.sin(np.arange(n) / 5) + rng.normal(0, 3, n)
        rows += [(k, i + 1, float(v)) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "k STRING, t BIGINT, y DOUBLE")


# --- positions, running totals -------------------------------------------------------------------


@FEW
@given(hst.lists(hst.integers(-10**6, 10**6), min_size=1, max_size=60, unique=True))
def test_positions_equal_ranks(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id BIGINT")
    got = {r.id: r.position for r in px.positions(df, "id", slots=5).collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(ids))}


def test_positions_with_a_hot_key(spark):
    rows = [("hot" if i % 3 else f"k{i}", i) for i in range(900)]
    df = spark.createDataFrame(rows, "k STRING, id BIGINT").repartition(6)
    out = px.positions(df, "id", ("k",), slots=16, total="n").toPandas()
    expected = out.groupby("k")["id"].rank().astype(int)
    assert (out["position"] == expected).all()
    assert (out["n"] == out.groupby("k")["id"].transform("size")).all()


def test_positions_keep_rows_without_key_or_slot(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", None), ("a", 5)], "k STRING, t INT")
    out = px.positions(df, "t", ("k",), slot=F.floor(F.col("t") / 2)).collect()
    assert {(r.k, r.t): r.position for r in out} == {(None, 1): 1, (None, 3): 2, ("a", None): 1, ("a", 5): 2}
    assert px.positions(df.select("t"), "t").count() == 4


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"x": np.unique(rng.exponential(100, 400)).round(6)}).drop_duplicates()
    pdf["v"] = rng.integers(0, 9, len(pdf))
    out = px.running_totals(spark.createDataFrame(pdf), "x", {"v": "sum_v"}, descending=descending, slots=9).toPandas()
    out = out.sort_values("x", ascending=not descending)
    assert (out["sum_v"] == out["v"].cumsum()).all()


@FEW
@given(hst.integers(1, 40), hst.integers(1, 9))
def test_tile_ends(spark, n, k):
    ends = spark.range(1).select(px.tile_ends(F.lit(n), k).alias("e")).first().e
    sizes = [n // k + (i < n % k) for i in range(k)]
    assert ends == sorted({sum(sizes[: j + 1]) for j in range(k - 1)})


def test_only_slots_with_a_cut_are_ranked(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 2).alias("c"))
    marked = px.quantile_slots(df, "id", 100)
    cuts = px.cut_values(marked, "id", ("c",), lambda total: px.tile_ends(total, 4))
    assert sorted(r._cuts for r in cuts.collect()) == [[4998, 9998, 14998], [4999, 9999, 14999]]
    ranked = marked.join(cuts.select(F.explode("_cuts").alias("cut")).distinct(), F.col("id") == F.col("cut")).select(px.SLOT).distinct().count()
    assert ranked <= 6
    plan = px.with_block(df, marked, "id", ("c",), lambda total: px.tile_ends(total, 4), "b")._jdf.queryExecution().executedPlan().toString()
    top = plan[plan.index("BroadcastHashJoin") :]
    assert "Exchange hashpartitioning" not in top.split("BroadcastExchange")[0]


# --- folds, samples ------------------------------------------------------------------------------


def test_stratified_folds_are_even_and_repeatable(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("c"))
    first = sp.stratified_folds(df, "id", "c", 7, seed=4)
    again = sp.stratified_folds(df.repartition(13), "id", "c", 7, seed=4)
    sizes = first.groupBy("c", "fold").count().groupBy("c").agg(
        (F.max("count") - F.min("count")).alias("gap"), F.count("*").alias("folds")
    )
    assert all(r.gap <= 1 and r.folds == 7 for r in sizes.collect())
    assert first.exceptAll(again).count() == 0 and first.count() == 1000


def test_unshuffled_folds_are_blocks(spark):
    folds = sp.plain_folds(spark.range(20), "id", 3).orderBy("id").toPandas()["fold"].tolist()
    assert folds == [1] * 7 + [2] * 7 + [3] * 6
    blocks = sp.ordered_stratified_folds(spark.range(20).withColumn("c", F.col("id") % 2), "id", "c", 2)
    assert blocks.groupBy("c", "fold").agg(F.max("id") - F.min("id")).count() == 4


def test_head_split_and_skip(spark):
    split = sp.head_split(spark.range(101), "id", 0.7, seed=3).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in split} == {"train": 70, "test": 31}
    assert [r.id for r in sp.skip_rows(spark.range(10), "id", 7).orderBy("id").collect()] == [7, 8, 9]


def test_shuffle_is_a_permutation(spark):
    out = sp.shuffled(spark.range(300), "id", seed=1).toPandas()
    assert sorted(out["shuffle_pos"]) == list(range(1, 301))
    assert out.sort_values("shuffle_pos")["id"].tolist() != list(range(300))


def test_sample_and_split_shares(spark):
    assert 20 <= sp.sample(spark.range(10000), "id", 5, seed=1).count() <= 90
    parts = spark.range(10000).withColumn("p", sp.split_column("id", {"a": 0.8, "b": 0.3}, 42)).groupBy("p").count()
    share = {r.p: r["count"] / 10000 for r in parts.collect()}
    assert share["a"] == pytest.approx(0.727, abs=0.02)


# --- series --------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [13, 100_000])
def test_lags(spark, block):
    out = se.lags(series(spark, 120, ("a", "b")), "t", "y", 40, ("k",), block).toPandas().sort_values(["k", "t"])
    for _, g in out.groupby("k"):
        for i in (1, 7, 39):
            pd.testing.assert_series_equal(g[f"lag_{i}"], g["lag_0"].shift(i), check_names=False)


@pytest.mark.parametrize("block", [17, 100_000])
def test_autocorrelation(spark, block):
    df = series(spark, 300)
    y = df.orderBy("t").toPandas()["y"].to_numpy()
    d = y - y.mean()
    want = [float((d[: len(d) - k] * d[k:]).sum() / (d * d).sum()) for k in range(41)]
    out = se.autocorrelation(df, "t", "y", 40, block=block).orderBy("lag").toPandas()
    assert out["acf"].to_numpy() == pytest.approx(want, abs=1e-9)
    assert out["acf"][0] == 1.0 and out["band"][0] == 0.0
    assert out["band"][1] == pytest.approx(1.959964 / np.sqrt(300), rel=1e-6)
    assert out["band"][2] == pytest.approx(1.959964 * np.sqrt((1 + 2 * want[1] ** 2) / 300), rel=1e-6)


def test_autocorrelation_of_a_constant_is_null(spark):
    flat = spark.range(1, 60).select(F.col("id").alias("t"), F.lit(3.0).alias("y"))
    assert {r.acf for r in se.autocorrelation(flat, "t", "y", 5).collect()} == {None}


@pytest.mark.parametrize("block", [11, 100_000])
def test_lag_correlations(spark, block):
    df = series(spark, 90, ("a", "b"), seed=3)
    out = se.lag_correlations(df, "t", "y", 12, ("k",), block).toPandas()
    for key, g in out.groupby("k"):
        y = df.where(F.col("k") == key).orderBy("t").toPandas()["y"]
        want = pd.concat([y.shift(i) for i in range(12)], axis=1, keys=range(12)).corr()
        assert len(g) == 66
        assert g["r"].to_numpy() == pytest.approx([want.loc[i, j] for i, j in zip(g["i"], g["j"])], abs=1e-9)


@pytest.mark.parametrize(("period", "block"), [(30, 19), (30, 100_000), (7, 16)])
def test_seasonal_parts(spark, period, block):
    df = series(spark, 200, ("a", "b"), seed=5)
    out = se.seasonal_parts(df, "t", "y", period, ("k",), block).toPandas().sort_values(["k", "t"])
    half = period // 2
    kernel = np.ones(2 * half + 1)
    if period % 2 == 0:
        kernel[[0, -1]] = 0.5
    for _, g in out.groupby("k"):
        y = g["y"].to_numpy()
        trend = np.convolve(y, kernel / period, "valid")
        assert g["trend"].isna().sum() == 2 * half
        assert g["trend"].to_numpy()[half:-half] == pytest.approx(trend, abs=1e-9)
        known = g.dropna()
        assert (known["trend"] + known["seasonal"] + known["resid"]).to_numpy() == pytest.approx(known["y"].to_numpy())
        assert g["seasonal"].to_numpy()[:period].sum() == pytest.approx(0, abs=1e-9)


def test_short_series_has_no_trend(spark):
    out = se.seasonal_parts(series(spark, 20), "t", "y", 30).collect()
    assert len(out) == 20 and all(r.trend is None for r in out)


def test_spectrum_equals_fft(spark):
    df = series(spark, 365)
    y = df.orderBy("t").toPandas()["y"].to_numpy()
    want = 2 / len(y) * np.abs(np.fft.fft(y))[1:40]
    out = se.spectrum(df, "t", "y", 39).orderBy("k").toPandas()
    assert out["amplitude"].to_numpy() == pytest.approx(want, abs=1e-6)


def test_between(spark):
    assert [r.id for r in se.between(spark.range(10), "id", 3, 6).orderBy("id").collect()] == [3, 4, 5]
    assert se.between(spark.range(10), "id", 8).count() == 2


# --- joins, texts, words -------------------------------------------------------------------------


def test_salted_join_keeps_every_row(spark):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    small = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = sk.hot_keys(big.groupBy("k").agg(F.count("*").alias("n")), ["k"], "n")
    assert {r.k: r.salts for r in hot.collect()}[0] >= 5
    salted = sk.salted_join(big, small, ["k"], hot, F.col("id"))
    plain = big.join(small, "k").select("k", "id", "v")
    assert salted.select("k", "id", "v").exceptAll(plain).count() == 0
    assert salted.count() == plain.count() == 3000


def test_ordered_text_is_one_row_per_key(spark):
    rows = [("big", i * 10_000, f"w{i}") for i in range(10_001)] + [("b", 5, "x"), ("b", 1, "y"), (None, 3, "z"), ("n", 1, None)]
    df = spark.createDataFrame(rows, "k STRING, seq BIGINT, word STRING").repartition(5)
    out = {r.k: r.text for r in rel.ordered_text(df, ["k"], "seq", "word", "\n", "text").collect()}
    assert out.pop("big").split("\n") == [f"w{i}" for i in range(10_001)]
    assert out == {"b": "y\nx", None: "z", "n": None}


def test_ordered_text_keeps_texts_without_a_key(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b")], "k STRING, seq BIGINT, word STRING")
    assert [tuple(r) for r in rel.ordered_text(df, ["k"], "seq", "word", " ", "text").collect()] == [(None, "a b")]


def test_ordered_text_quotes_the_separator(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b")], "k STRING, seq BIGINT, word STRING")
    assert rel.ordered_text(df, ["k"], "seq", "word", "'\\", "text").first().text == "a'\\b"


def test_vocabulary_and_bags(spark):
    df = spark.createDataFrame([(1, "a a b"), (2, "b c"), (3, "b a"), (4, "")], "id INT, text STRING")
    words = tx.words(F.col("text"))
    terms = wd.vocabulary(df, words, 2, min_df=2)
    assert [tuple(r) for r in terms.collect()] == [("a", 3, 2), ("b", 3, 3)]
    bag = {(r.id, r.word): r["count"] for r in wd.term_counts(df, "id", words, terms).collect()}
    assert bag == {(1, "a"): 2, (1, "b"): 1, (2, "b"): 1, (3, "a"): 1, (3, "b"): 1}
    same, same_terms = wd.bag_of(df, "id", words, 2, min_df=2)
    assert {(r.id, r.word): r["count"] for r in same.collect()} == bag
    assert [tuple(r) for r in same_terms.collect()] == [("a", 3, 2), ("b", 3, 3)]


def test_distinct_values_has_no_limit(spark):
    df = spark.range(3000).select(F.when(F.col("id") > 0, F.format_string("%04d", F.col("id") % 1500)).alias("g"))
    assert rel.distinct_values(df, "g") == [f"{i:04d}" for i in range(1500)]


def test_lookup_with_default(spark):
    known = spark.createDataFrame([("nvidia",)], "m STRING")
    df = spark.createDataFrame([("Nvidia",), ("Other",), (None,)], "e STRING")
    got = {r.e: r.m for r in rel.lookup_with_default(df, known, F.col("e"), "m").collect()}
    assert got == {"Nvidia": "nvidia", "Other": "*", None: "*"}


def test_first_by_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k STRING, t INT, v STRING")
    got = {r.k: (r.t, r.v) for r in pf.first_by_key(df, "k", ["t", "v"], ["t", "v"]).collect()}
    assert got == {"a": (1, "y"), "b": (5, "z")}


# --- statistics and metrics ----------------------------------------------------------------------


@FEW
@given(hst.lists(hst.one_of(hst.none(), hst.integers(-50, 50).map(float)), min_size=1, max_size=60), hst.integers(1, 12))
def test_histogram(spark, xs, bins):
    present = [x for x in xs if x is not None]
    df = spark.createDataFrame([(x,) for x in xs], "x DOUBLE")
    got = {r.bin: r["count"] for r in stats.histogram(df, "x", bins).collect()}
    assert sum(got.values()) == len(present)
    if present and min(present) == max(present):
        assert got == {0: len(present)}
    elif present:
        want, _ = np.histogram(present, bins)
        # numpy settles values on inner edges its own way; ends and totals agree
        assert min(got) == 0 and max(got) == bins - 1 and sum(want) == sum(got.values())


def test_weighted_histogram(spark):
    df = spark.createDataFrame([(0.0, 5), (1.0, 2), (10.0, 1)], "x DOUBLE, w INT")
    got = {r.bin: (r["count"], r.weight) for r in stats.histogram(df, "x", 5, "w").collect()}
    assert got == {0: (2, 7), 4: (1, 1)}


def test_class_metrics(spark):
    rows = [(1, 1), (1, 1), (2, 2), (2, 1), (3, 3), (3, 3)]
    classes = mt.per_class(mt.confusion(spark.createDataFrame(rows, "y INT, p INT"), "y", "p"))
    table = {r["class"]: r for r in classes.collect()}
    assert table[1].precision == pytest.approx(2 / 3) and table[1].recall == 1
    assert table[2].recall == 0.5 and table[2].precision == 1
    row = mt.class_summary(classes).first()
    assert row.accuracy == pytest.approx(5 / 6) == row.weighted_recall
    assert row.macro_precision == pytest.approx(8 / 9) and row.macro_recall == pytest.approx(5 / 6)


def test_class_never_predicted_or_never_present(spark):
    rows = [("a", "b"), ("a", "a")]
    classes = mt.per_class(mt.confusion(spark.createDataFrame(rows, "y STRING, p STRING"), "y", "p"))
    table = {r["class"]: r for r in classes.collect()}
    assert (table["b"].support, table["b"].precision, table["b"].recall, table["b"].f1) == (0, 0, 0, 0)


def test_metrics_agree_with_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator

    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 400)
    score = (y * 0.4 + rng.random(400)).round(2)
    df = spark.createDataFrame(
        [(float(a), float(b > 0.7), float(b)) for a, b in zip(y, score)], "label DOUBLE, prediction DOUBLE, score DOUBLE"
    )
    row = mt.class_summary(mt.per_class(mt.confusion(df, "label", "prediction"))).first()
    for ours, theirs in (
        ("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1"),
    ):
        assert row[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df))
    counts = mt.threshold_counts(df, "score", "label")
    area = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert mt.area_under_roc(counts).first().auc == pytest.approx(area)
    curve = mt.roc(counts).orderBy("FPR", "TPR").toPandas()
    assert curve["TPR"].is_monotonic_increasing and tuple(curve.iloc[-1]) == (1, 1) and tuple(curve.iloc[0]) == (0, 0)
    metrics = mt.regression_metrics(df, "label", "score").first()
    for name in ("r2", "rmse", "mse", "mae"):
        assert metrics[name] == pytest.approx(
            RegressionEvaluator(labelCol="label", predictionCol="score", metricName=name).evaluate(df)
        )


def test_best_threshold_takes_the_lowest_of_equals(spark):
    f = spark.createDataFrame([(0.3, 0.8), (0.2, 0.8), (0.9, 0.1)], "threshold DOUBLE, `F-Measure` DOUBLE")
    assert mt.best_threshold(f).first().threshold == 0.2


def test_binary_rates_of_one_class(spark):
    row = mt.binary_rates(spark.createDataFrame([(1, 1), (1, 0)], "y INT, p INT"), "y", "p").first()
    assert (row.tp, row.fn, row.tpr, row.fpr) == (1, 1, 0.5, 0.0)


# --- least squares -------------------------------------------------------------------------------


def test_ols_against_normal_equations(spark):
    rng = np.random.default_rng(7)
    x = rng.uniform(0, 50, 100)
    y = -10 * x**2 + 500 * x - 25 + rng.normal(0, 100, 100)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "X DOUBLE, Y DOUBLE")
    row = rg.ols(df, "X", "Y").first()
    design = np.column_stack([np.ones(100), x])
    beta, sse, *_ = np.linalg.lstsq(design, y, rcond=None)
    se_ = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * sse[0] / 98)
    assert (row.intercept, row.slope) == pytest.approx(tuple(beta))
    assert (row.intercept_se, row.slope_se) == pytest.approx(tuple(se_))
    assert row.slope_t == pytest.approx(beta[1] / se_[1])
    t = 1.984467454  # 97.5 % point of Student's t with 98 degrees of freedom
    assert row.slope_lo == pytest.approx(beta[1] - t * se_[1], rel=1e-7)
    assert row.intercept_hi == pytest.approx(beta[0] + t * se_[0], rel=1e-7)


def test_ols_of_constant_or_tiny_groups_is_null(spark):
    df = spark.createDataFrame(
        [("c", 1.0, 2.0), ("c", 1.0, 3.0), ("one", 5.0, 5.0), ("two", 1.0, 1.0), ("two", 2.0, 3.0)],
        "k STRING, x DOUBLE, y DOUBLE",
    )
    rows = {r.k: r for r in rg.ols(df, "x", "y", ("k",)).collect()}
    assert rows["c"].slope is None and rows["one"].slope is None
    assert rows["two"].slope == 2 and rows["two"].slope_se is None


def test_fold_lines(spark):
    rng = np.random.default_rng(8)
    x = rng.uniform(1000, 1010, 60)
    y = 3 * x + rng.normal(0, 1, 60)
    fold = np.arange(60) % 4
    df = spark.createDataFrame(
        [(float(a), float(b), int(f)) for a, b, f in zip(x, y, fold)], "x DOUBLE, y DOUBLE, fold INT"
    )
    for r in rg.fold_lines(df, "x", "y", "fold").collect():
        b, a = np.polyfit(x[fold != r.fold] - 1005, y[fold != r.fold], 1)
        assert r.slope == pytest.approx(b)
        error = y[fold == r.fold] - (a + b * (x[fold == r.fold] - 1005))
        assert r.rmse == pytest.approx(np.sqrt(np.mean(error**2)))


def test_flag_vectors_of_ten_thousand_genres(spark):
    rows = spark.range(0, 4000, 1, 4).select(
        "id", F.expr("transform(sequence(0, 4), k -> if(k = 0, 'all', concat('g', pmod(id * 7 + k * 2503, 10000))))").alias("l")
    )
    odd = spark.createDataFrame([(9000, []), (9001, None), (9002, ["\u00fc", "all", "all", "none", None])], "id LONG, l ARRAY<STRING>")
    table = rows.union(odd)
    vectors, codes = rel.flag_vectors(table, "id", F.col("l"), skip=("none",))
    lists = {r.id: {v for v in r.l or [] if v not in (None, "none")} for r in table.collect()}
    names = sorted(set().union(*lists.values()), key=lambda v: v.encode())
    assert {r.value: r.code for r in codes.collect()} == {v: k for k, v in enumerate(names)}
    got = {r.id: (r.size, r.indices) for r in vectors.collect()}
    place = {v: k for k, v in enumerate(names)}
    assert got == {i: (len(names), sorted(place[v] for v in values)) for i, values in lists.items()}


def test_flag_vectors_of_no_rows(spark):
    vectors, codes = rel.flag_vectors(spark.createDataFrame([], "id LONG, l ARRAY<STRING>"), "id", F.col("l"))
    assert vectors.count() == codes.count() == 0


def test_bags_are_coded_in_slices(spark, monkeypatch):
    monkeypatch.setattr(wd, "SLICE_WORDS", 3)
    rows = spark.createDataFrame([(1, ["a", "b", "a"]), (2, None), (3, ["z"] * 9), (4, ["b"]), (5, [])], "id INT, w ARRAY<STRING>").coalesce(1)
    told = {r.id: (r.features, r["values"]) for r in wd.coded(rows, "w", ["b", "a"]).collect()}
    assert told == {1: ([0, 1], [1, 2]), 2: ([], []), 3: ([], []), 4: ([0], [1]), 5: ([], [])}
