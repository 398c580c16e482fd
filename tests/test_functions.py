"""Expressions on hand-made rows."""

import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quern.functions import hashing as hs
from quern.functions import maths as mx
from quern.functions import text as tx
from quern.functions import time as tm
from quern.functions import vectors as vc
from quern.operators import regression as rg


def values(spark, inputs, fn, type_="STRING"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    out = spark.createDataFrame(rows, f"i INT, v {type_}").select("i", fn(F.col("v")).alias("r"))
    return [r.r for r in out.orderBy("i").collect()]


TITLES = ["Toy Story (1995)", "Trail (1999) ", "No Year", "Dup (a) (2001)", "(2000)", ""]


def test_titles(spark):
    assert values(spark, TITLES, tx.clean_title) == ["Toy Story", "Trail", "No Year", "Dup (a)", "(2000)", ""]
    assert values(spark, TITLES, tx.strict_year) == ["1995", "", "", "2001", "", ""]
    assert values(spark, TITLES, tx.strict_title) == ["Toy Story ", "", "", "Dup (a) ", "", ""]


def test_pipe_list(spark):
    got = values(spark, ["a|b|c", "a", "(no genres listed)", ""], tx.pipe_list)
    assert got == [["a", "b", "c"], ["a"], ["(no genres listed)"], [""]]


TEXTS = ["a  b ", "", "one", " \t\n", "x y z", "é\x1cf", "Ala, ma—kota…”OK„  1x"]


def test_words_split_like_str_split(spark):
    assert values(spark, TEXTS, tx.words) == [t.split() for t in TEXTS]


def test_blank_count_counts_runs(spark):
    assert values(spark, ["a b ", "a  b ", "", "one"], tx.blank_count_words) == [3, 4, 1, 1]


def test_tokens(spark):
    assert values(spark, TEXTS, tx.tokens)[-1] == ["ala", "ma", "kota", "ok", "1x"]
    assert values(spark, ["...", "", "—…”„"], tx.tokens) == [[], [], []]
    assert values(spark, ["A bb c_1 é éa 22 x"], tx.tokens_2plus) == [["bb", "c_1", "éa", "22"]]


def test_html_words_drop_markup_scripts_comments_and_numbers(spark):
    html = (
        "<html><head><style>p{a:b}</style><script>var t='</p>word';</script><title>T&amp;itle</title></head>"
        "<!-- hid > den --><body><p class=\"a>b\">One&nbsp;two[1] 3.5 &lt;x&gt; a < b</p>caf&#233; &#x41;B &amp;lt;"
    )
    assert values(spark, [html], tx.html_words) == [["T", "itle", "One", "two", "x", "a", "b", "café", "AB", "lt"]]


def test_html_unclosed_script_and_comment(spark):
    assert values(spark, ["a<script>b", "a<!-- b", "a<br/>b<p"], tx.html_words) == [["a"], ["a"], ["a", "b", "p"]]


def test_html_with_very_many_attributes_or_very_long_parts(spark):
    html = "<p " + 'a="b>c" ' * 30_000 + ">x<!--" + "-" * 200_000 + "-->y<script>" + "<" * 200_000 + "</script>z <a b='c>d"
    assert values(spark, [html], tx.html_words) == [["x", "y", "z", "d"]]


def test_html_text_decodes_once(spark):
    assert values(spark, ["&amp;lt; &quot;x&quot; &copy; &unknown;"], tx.html_text) == ['&lt; "x" © &unknown;']


def test_all_html_references(spark):
    given = ["a&#9;b", "&#x10FFFF;", "&#55357;&#56832;&#xD83D;&#xDE00;", "&eacute;&NotEqualTilde;&hearts;", "&#0;&#99999999999999;&#xD800;", "&#150;&#000233;&#X41;", "&#38;lt;&AMP;amp;"]
    want = ["a\tb", "\U0010ffff", "😀😀", "é≂̸♥", "\ufffd\ufffd\ufffd", "–éA", "&lt;&amp;"]
    assert values(spark, given, tx.decode_entities) == want


def test_t_distribution(spark):
    # Published two-sided 5 % and 1 % points.
    known = [(1, 12.7062, 0.05), (2, 4.30265, 0.05), (3, 3.18245, 0.05), (5, 4.03214, 0.01), (10, 2.22814, 0.05), (30, 2.75000, 0.01), (120, 1.97993, 0.05), (1000, 1.96234, 0.05), (10**7, 1.959964, 0.05)]
    df = spark.createDataFrame(known, "v BIGINT, t DOUBLE, p DOUBLE")
    for r in df.select("*", rg.two_sided_p(F.col("t"), F.col("v")).alias("got"), rg.t_quantile_975(F.col("v")).alias("q")).collect():
        assert r.got == pytest.approx(r.p, rel=2e-4)
        if r.p == 0.05:
            assert r.q == pytest.approx(r.t, rel=1e-5)
    far = spark.range(1).select(rg.two_sided_p(F.lit(8.0), F.lit(10**6)).alias("a"), rg.two_sided_p(F.lit(0.0), F.lit(7)).alias("b")).first()
    assert far.a == pytest.approx(1.244e-15, rel=0.01) and far.b == 1.0


def test_times(spark):
    assert values(spark, [0, 951782400 + 3661], tm.epoch_text, "BIGINT") == [
        "1970-01-01 00:00:00",
        "2000-02-29 01:01:01",
    ]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(spark, [0], tm.epoch_text, "BIGINT") == ["1970-01-01 00:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    day = spark.sql("SELECT timestamp_ntz'2016-01-14 00:00:05' d")
    assert day.select(tm.utc_epoch(F.col("d"))).first()[0] == 1452729605


def test_year_gap_is_null_for_texts_without_a_year(spark):
    df = spark.createDataFrame([("2000", "1995"), ("2000", ""), ("", "1"), ("1999", "2000")], "a STRING, b STRING")
    got = [r.g for r in df.select(tm.year_gap(F.col("a"), F.col("b")).alias("g")).collect()]
    assert got == [5, None, None, -1]


def test_safe_corr(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 7.0, 5.0), (None, 1.0, 5.0)], "x DOUBLE, y DOUBLE, c DOUBLE"
    )
    row = df.agg(
        mx.safe_corr(F.col("x"), F.col("y")).alias("r"), mx.safe_corr(F.col("x"), F.col("c")).alias("n")
    ).first()
    assert row.r == pytest.approx(0.99339927)
    assert row.n is None


def test_logistic_and_odds(spark):
    row = spark.range(1).select(
        mx.logistic(F.lit(0.0)).alias("half"),
        mx.odds_ratio(F.lit(0.7788)).alias("ratio"),
        mx.odds_percent(F.lit(0.0)).alias("none"),
    ).first()
    assert (row.half, row.none) == (0.5, 0.0)
    assert row.ratio == pytest.approx(math.exp(0.7788))


def test_vector_maximum(spark):
    df = spark.createDataFrame([(Vectors.dense([0.2, 0.8]),), (Vectors.sparse(3, [1], [0.5]),)], ["v"])
    assert [r.m for r in df.select(vc.max_element(F.col("v")).alias("m")).collect()] == [0.8, 0.5]
    vc.register_array_max(spark)
    assert spark.sql("SELECT maxVectorElement(array(0.25D, 0.75D)) AS m").first().m == 0.75


def test_hash_numbers_are_even(spark):
    row = spark.range(20000).agg(
        F.avg(hs.hash_unit(F.col("id"), 1)).alias("mean"),
        F.countDistinct(hs.hash_bucket(F.col("id"), 1, 100)).alias("buckets"),
    ).first()
    assert row.mean == pytest.approx(0.5, abs=0.01)
    assert row.buckets == 100
