from collections import Counter

from pyspark.sql import functions as F

from quern.llm import quality
from quern.sources.tables import table
from tests.llm.helpers import none, odd, words


def counts(text):
    w, text = words(text), text or ""
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    seen = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if seen[x] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered)


def test_counts_are_those_of_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for r in quality.document_quality(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        assert tuple(r[c] for c in quality.COUNTS) == counts(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_repeated_windows_overlap(spark):
    for text in ["a b c a b c", "a a a a", "a a a", "x a b c y a b c", "a b"]:
        got = quality.counted(spark.createDataFrame([(text,)], "text string")).first().counts
        assert got.n_repeat_words == counts(text)[-1], text


def test_sketches_add_up(spark, sf_dir):
    docs = quality.counted(table(spark, sf_dir, "documents"))
    whole = quality.sketches(docs, "lang", "source")
    halves = [quality.sketches(docs.where(F.col("doc_id") % 2 == k), "lang", "source") for k in (0, 1)]
    summed = halves[0].union(halves[1]).groupBy("lang", "source", "measure", "bucket").agg(F.sum("n").alias("n"))
    assert whole.exceptAll(summed).count() == summed.exceptAll(whole).count() == 0


def test_limits_follow_the_source(spark):
    good = [(k, f"w{k} " + " ".join(f"term{k}x{j}" for j in range(60)), "en", "a") for k in range(150)]
    noisy = [(1000 + k, " ".join(f"te#m{k}x{j}" for j in range(60)), "en", "b") for k in range(150)]
    stray = [(5000, " ".join(f"te#m{j}y" for j in range(60)), "en", "a")]
    docs = spark.createDataFrame(good + noisy + stray, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.document_quality(docs).collect()}
    assert kept.pop(5000) is False and all(kept.values())


def test_many_groups_take_the_shuffle(spark, sf_dir):
    rows = quality.counted(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    bounds = quality.limits(quality.sketches(rows, "lang", "source"))
    few, many = (quality.judged(rows, bounds, n, "lang", "source").select("doc_id", "kept") for n in (1, 10**9))
    assert few.exceptAll(many).count() == many.exceptAll(few).count() == 0


def test_no_python_on_the_path(spark, sf_dir):
    plan = quality.document_quality(table(spark, sf_dir, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_odd_rows(spark):
    told = quality.document_quality(odd(spark)).collect()
    assert len(told) == 8 and all(r.base_failed and not r.kept for r in told)
    docs = odd(spark)
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.document_quality(none(spark)).count() == quality.keep_good(none(spark)).count() == 0
