"""Language identification and toxicity: held-out accuracy and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import frames, language, queries, toxicity
from quern.llm.frames import id_remainder, sampled_rows
from quern.sources.tables import table
from tests.llm.helpers import none, odd

DATA = "/root/testdata/sf0.01"


def test_letters_stand_between_single_blanks():
    assert "".join(map(chr, language.letters("  Ab1é!\tÇ "))) == " ab é ç "
    assert "".join(map(chr, language.letters(""))).strip() == ""


def test_languages_of_held_out_documents(spark):
    docs = table(spark, DATA, "documents").select("doc_id", "lang")
    told = queries.QUERIES["op6_language_id"](spark, DATA).join(docs, "doc_id").where("held_out and lang_pred <> 'und'")
    right = told.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98
    assert told.where("score < 0 or score > 1").count() == 0


def test_held_out_rows_do_not_teach(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = id_remainder("doc_id", 4) == 2
    spoiled = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    assert "xx" not in language.fit(spoiled.where(~held)).langs


def test_language_of_odd_rows(spark):
    model = language.fit(odd(spark))
    told = language.identify(odd(spark), model).collect()
    assert len(told) == 8 and [r.lang_pred for r in told if r.row.doc_id in (2, 3, 4)] == ["und"] * 3
    assert {r.lang_pred for r in told if r.row.doc_id == 7} == {"en"}
    assert language.identify(none(spark), model).count() == 0
    nothing = language.fit(none(spark))
    assert {(r.lang_pred, r.score, r.rejected) for r in language.identify(odd(spark), nothing).collect()} == {("und", 0.0, True)}


def test_far_texts_are_rejected(spark):
    docs = table(spark, DATA, "documents")
    model = language.fit(docs)
    far = spark.createDataFrame([(1, "日本語のテキストです。これは学習されていない言語です。"), (2, "Съешь же ещё этих мягких булок")], "doc_id long, text string")
    assert all(r.rejected for r in language.identify(far, model).collect())
    near = language.identify(docs.where("length(text) > 300"), model)
    assert near.where("rejected").count() <= 0.01 * near.count()


def test_toxicity_of_held_out_documents(spark):
    told = queries.QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1").join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id")
    rows = told.where("held_out").select("score", "predicted", "toxic").collect()
    hits = [r.predicted for r in rows if r.toxic == 1]
    alarms = [r.predicted for r in rows if r.toxic == 0]
    assert np.mean(hits) > 0.8 and np.mean(alarms) < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_labels_do_not_teach(spark):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    held = id_remainder("doc_id", 5) == 0
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs.where(~held), told) for told in (labels, flipped))
    assert a.intercept == b.intercept and (a.weights == b.weights).all() and a.weights.any()


def test_toxicity_of_odd_rows(spark):
    docs = odd(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (7, 0), (None, 1), (5, None), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    told = toxicity.score(docs, model).collect()
    assert len(told) == 8 and all(0 <= r.score <= 1 for r in told)
    assert len({r.score for r in told if r.row.doc_id in (2, 3, 4)}) == 1
    assert toxicity.score(none(spark), model).count() == 0
    one = toxicity.fit(docs, labels.where("toxic = 0"))
    assert all(r.score < 0.01 for r in toxicity.score(docs, one).collect())
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.5}


@pytest.mark.parametrize("broadcast", [0, 1 << 20])
def test_samples_are_bounded_whatever_the_keys(spark, monkeypatch, broadcast):
    monkeypatch.setattr(frames, "BROADCAST_DRAWS", broadcast)
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 7, id) as id", "concat('text ', id % 5000) as text", "cast(id % 2 as string) as lang")
    for parts in (2, 9):
        found = sampled_rows(rows.repartition(parts), "lang", 600, "id", "text")
        assert {r.lang: r["count"] for r in found.groupBy("lang").count().collect()} == {"0": 600, "1": 600}
        total = found.agg(F.sum(F.xxhash64("id", "text", "lang").cast("decimal(38,0)"))).first()[0]
        assert parts == 2 or total == before
        before = total
    three = spark.range(20_000).selectExpr("cast(id % 3 as long) as id", "concat('t', id % 3) as text", "'en' as lang")
    assert sampled_rows(three, "lang", 600, "id", "text").count() == 3
    assert sampled_rows(three.withColumn("id", F.lit(None).cast("long")), "lang", 2, "id", "text").count() == 2
    many = spark.range(6_000).selectExpr("id", "'x' as text", "cast(id % 2000 as string) as lang")
    assert sampled_rows(many, "lang", 2, "id", "text").count() == 4_000


def test_hot_and_repeated_ids_do_not_fill_the_sample(spark):
    docs = spark.range(4_000).selectExpr("if(id < 1500, 1, id) as doc_id", "concat(if(id % 2 = 0, 'bad ', 'good '), id) as text")
    labels = spark.range(4_000).selectExpr("if(id < 1500, 1, id) as doc_id", "cast(id % 2 = 0 as int) as toxic")
    told = toxicity.score(docs, toxicity.fit(docs, labels)).where("row.doc_id > 1").select("row.doc_id", "score").collect()
    assert np.mean([(r.score > 0.5) == (r.doc_id % 2 == 0) for r in told]) > 0.95


def test_many_languages(spark):
    docs = spark.range(1_200).selectExpr("id as doc_id", "concat('abc', char(97 + id % 20), 'de') as text", "concat('l', id % 400) as lang")
    model = language.fit(docs)
    assert len(model.langs) >= 400 and language.identify(docs, model).where("rejected").count() < 1_200
