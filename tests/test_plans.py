"""Physical plans: what must and must not be in them."""

import pytest
from pyspark.sql import functions as F

from quern.functions import text as tx
from quern.operators import bayes as nb
from quern.operators import prefix as px
from quern.operators import words as wd
from quern.plans import JOBS

SLOW_OPERATORS = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "genre_stats_top3", "title_stats", "genre_above_average", "tags_per_user", "user_rating_scatter",
        "release_lag_hist", "word_top10", "html_word_top10", "doc_term_counts", "nb_classify", "acf40", "lag_matrix",
        "seasonal_parts", "spectrum39", "confidence_lines", "regression_metrics", "roc_curve", "macro_metrics",
        "stratified_folds", "plain_folds", "md5_shuffle", "monte_carlo_pi", "trend_by_country",
    ],
)
def test_no_slow_operators(spark, sf_dir, name):
    text = plan(JOBS[name](spark, sf_dir))
    assert [op for op in SLOW_OPERATORS if op in text] == []


def test_ratings_are_reduced_before_the_join(spark, sf_dir):
    text = plan(JOBS["genre_stats_top3"](spark, sf_dir))
    assert "TakeOrderedAndProject" in text
    ratings_side = text[text.index("Join") :]
    assert "partial_sum(rating" in ratings_side
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text


def test_filters_reach_the_scan(spark, sf_dir):
    assert "EqualTo(source,src3)" in plan(JOBS["entity_filter"](spark, sf_dir))


def test_pages_are_a_bounded_heap(spark, sf_dir):
    text = plan(JOBS["offset_page"](spark, sf_dir))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_positions_shuffle_the_rows_once(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 3).alias("k"))
    out = px.positions(rows, "id", ("k",), slot=F.floor(F.col("id") / 100))
    row_shuffles = [line for line in plan(out).splitlines() if "Exchange hashpartitioning(_group" in line]
    # rows, slot counts, and the slot offsets on their way to the join
    assert len(row_shuffles) <= 3


def test_words_are_counted_without_a_shuffle(spark):
    docs = spark.range(100).select("id", F.lit("a b a").alias("t")).repartition(40)
    out = plan(wd.term_counts(docs, "id", tx.words(F.col("t"))))
    assert out.count("Exchange") == 1 and "RoundRobin" in out  # the repartition above


def test_bayes_scores_shuffle_words_once(spark):
    docs = spark.range(60).selectExpr("id", "cast(id % 3 as int) y", "concat('w', id % 7, ' common') t").repartition(40)
    words = tx.words(F.col("t"))
    model = nb.weights(nb.fit(docs, words, "y"))
    out = plan(nb.classify(docs, "id", words, model, entity=nb.ALL))
    assert "CartesianProduct" not in out and "BroadcastNestedLoopJoin" not in out


def test_slots_follow_the_cluster(spark):
    assert px.default_slots(spark) == 64
    spark.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        assert px.default_slots(spark) == 2000
        spark.conf.set("spark.sql.shuffle.partitions", "100000")
        assert px.default_slots(spark) == 400_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
