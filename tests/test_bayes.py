"""Naive Bayes: known values, agreement with MLlib, entities and fallback."""

import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizer, StringIndexer
from pyspark.sql import functions as F

from quern.functions import text as tx
from quern.operators import bayes as nb

# A corpus small enough to check by hand, and its probabilities with smoothing 0.01.
CORPUS = [
    ("Ala", "aaa aaa bbb ccc"),
    ("Ala", "aaa bbb ddd"),
    ("Ala", "aaa bbb"),
    ("Ala", "aaa bbb bbb"),
    ("Ola", "aaa ccc ddd"),
    ("Ola", "bbb ccc ddd"),
    ("Ola", "ccc ddd eee"),
]
KNOWN = {
    ("Ala", "aaa"): 0.415768, ("Ala", "bbb"): 0.415768, ("Ala", "ccc"): 0.083817, ("Ala", "ddd"): 0.083817,
    ("Ola", "aaa"): 0.111602, ("Ola", "bbb"): 0.111602, ("Ola", "eee"): 0.111602,
    ("Ola", "ccc"): 0.332597, ("Ola", "ddd"): 0.332597,
}


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, a, t) for i, (a, t) in enumerate(CORPUS)]
    return spark.createDataFrame(rows, "id INT, author STRING, content STRING")


WORDS = tx.tokens


@pytest.fixture(params=[True, False], ids=["broadcast", "blocks"])
def both_ways(request, monkeypatch):
    """Scoring with a broadcast model and, block by block, with one of any size."""
    if not request.param:
        monkeypatch.setattr(nb, "BROADCAST_WORDS", -1)
        monkeypatch.setattr(nb, "PRODUCTS", 3)


def test_known_probabilities(spark, corpus):
    model = nb.fit(corpus, WORDS(F.col("content")), "author", smoothing=0.01)
    theta = {(r.label, r.word): r.p for r in model.theta.select("label", "word", F.exp("log_theta").alias("p")).collect()}
    assert theta == pytest.approx(KNOWN, abs=1e-6)
    classes = {r.label: r for r in model.classes.collect()}
    assert classes["Ala"].docs == 4 and classes["Ala"].vocabulary == 5
    prior = {r.label: r.p for r in model.classes.select("label", F.exp("log_prior").alias("p")).collect()}
    assert prior == pytest.approx({"Ala": 0.571225, "Ola": 0.428775}, abs=1e-6)
    default = {r.label: r.p for r in model.classes.select("label", F.exp("log_default").alias("p")).collect()}
    assert default["Ala"] == pytest.approx(0.000830, abs=1e-6)


def test_scores_equal_mllib(spark, corpus, both_ways):
    words = WORDS(F.col("content"))
    probe = spark.createDataFrame(
        [(1, "aaa ccc ccc ddd eee"), (2, "bbb unseen"), (3, "unseen"), (4, ""), (5, "aaa aaa aaa")],
        "id INT, content STRING",
    )
    weights = nb.weights(nb.fit(corpus, words, "author", smoothing=0.01))
    asked = probe.withColumn("model_entity", F.lit(nb.ALL))
    ours = {(r.id, r.label): r.score for r in nb.scores(asked, "id", words, weights).collect()}
    stages = [
        CountVectorizer(inputCol="words", outputCol="features"),
        StringIndexer(inputCol="author", outputCol="label"),
        NaiveBayes(smoothing=0.01),
    ]
    train = corpus.withColumn("words", words)
    fitted = Pipeline(stages=stages).fit(train)
    bag, labels, model = fitted.stages
    for row in bag.transform(probe.withColumn("words", words)).collect():
        raw = model.predictRaw(row.features)
        for i, label in enumerate(labels.labels):
            assert ours[(row.id, label)] == pytest.approx(raw[i])


def test_equal_scores_go_to_the_first_label(spark, both_ways):
    docs = spark.createDataFrame([(1, "b", "x"), (2, "a", "x")], "id INT, y STRING, t STRING")
    words = tx.words(F.col("t"))
    weights = nb.weights(nb.fit(docs, words, "y"))
    found = nb.classify(docs.withColumn("model_entity", F.lit("*")), "id", words, weights).collect()
    assert {r.prediction for r in found} == {"a"}


def test_blocks_of_any_size(spark, monkeypatch):
    docs = spark.range(300).selectExpr("id", "if(id % 3 = 0, 'a', 'b') y", "if(id % 7 = 0, null, concat('w', id % 40, ' w', id % 40, ' common ', id)) t").repartition(3)
    words = tx.words(F.col("t"))
    model = nb.fit(docs, words, "y")
    small = nb.weights(model)
    monkeypatch.setattr(nb, "BROADCAST_WORDS", 10)
    monkeypatch.setattr(nb, "BLOCK_WORDS", 50)
    large = nb.weights(model)
    assert small.small and not large.small
    a, b = ({(r.id, r.label): round(r.score, 9) for r in nb.scores(docs, "id", words, w, nb.ALL).collect()} for w in (small, large))
    assert a == b and len(a) == 600


def test_many_classes(spark, both_ways):
    docs = spark.range(700).selectExpr("cast(id as int) id", "concat('c', id % 350) y", "concat('w', id % 350, ' x') t")
    words = tx.words(F.col("t"))
    model = nb.weights(nb.fit(docs, words, "y"))
    found = nb.classify(docs.withColumn("model_entity", F.lit(nb.ALL)), "id", words, model)
    assert model.breadth == 350
    assert found.join(docs, "id").where("prediction <> y").count() == 0


def test_entity_models_and_fallback(spark, both_ways):
    rows = [
        ("Nvidia", "pos", "fast card"), ("Nvidia", "neg", "hot card"),
        ("Cola", "pos", "hot drink"), ("Cola", "neg", "flat drink"), ("Cola", "neg", "flat"),
    ]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id INT, e STRING, y STRING, t STRING")
    words = tx.words(F.col("t"))
    model = nb.fit(docs, words, "y", entity="e", prior_smoothing=0.0)
    classes = {(r.entity, r.label): r for r in model.classes.collect()}
    assert set(classes) == {(e, y) for e in ("nvidia", "cola", "*") for y in ("pos", "neg")}
    assert classes[("*", "neg")].docs == 3 and classes[("*", "neg")].words == 5
    assert classes[("nvidia", "pos")].vocabulary == 3
    weights = nb.weights(model)
    asked = spark.createDataFrame(
        [(1, "NVIDIA", "hot"), (2, "cola", "hot"), (3, "unheard", "flat"), (4, "cola", "fast fast")],
        "id INT, e STRING, t STRING",
    )
    found = {r.id: r for r in nb.classify(nb.with_model(asked, weights, F.col("e")), "id", words, weights).collect()}
    assert (found[1].model_entity, found[1].prediction) == ("nvidia", "neg")
    assert (found[2].model_entity, found[2].prediction) == ("cola", "pos")
    assert (found[3].model_entity, found[3].prediction) == ("*", "neg")
    assert found[4].prediction == "neg"  # no known word: the larger class


def test_entity_counts_equal_separate_fits(spark):
    rows = [(i, "hot" if i % 3 else f"e{i % 6}", i % 2, f"w{i % 7} w{i % 5} common") for i in range(120)]
    docs = spark.createDataFrame(rows, "id INT, e STRING, y INT, t STRING")
    words = tx.words(F.col("t"))
    joint = nb.fit(docs, words, "y", entity="e")
    alone = nb.fit(docs.where("e = 'hot'"), words, "y")
    both = nb.fit(docs, words, "y")
    columns = ["label", "word", "n", F.round("log_theta", 9).alias("l")]
    for entity, model in (("hot", alone), ("*", both)):
        ours = joint.theta.where(F.col("entity") == entity).select(*columns)
        theirs = model.theta.select(*columns)
        assert ours.exceptAll(theirs).count() == 0 == theirs.exceptAll(ours).count()


@pytest.mark.parametrize("common", [0, 20, 1000])
def test_large_models_broadcast_frequent_words_only(spark, monkeypatch, common):
    docs = spark.range(200).selectExpr("id", "if(id % 3 = 0, 'a', 'b') y", "if(id % 7 = 0, null, concat('w', id % 9, ' w', id % 9, ' common ', id)) t").repartition(2)
    words = tx.words(F.col("t"))
    model = nb.fit(docs, words, "y")
    small = nb.weights(model)
    monkeypatch.setattr(nb, "BROADCAST_WORDS", 10)
    monkeypatch.setattr(nb, "COMMON_WORDS", common)
    large = nb.weights(model)
    assert len(large.common.value.pair) <= common
    assert "FlatMapCoGroups" not in nb.classify(docs, "id", words, large, nb.ALL)._jdf.queryExecution().toString()
    a, b = ({(r.id, r.label): round(r.score, 9) for r in nb.scores(docs, "id", words, w, nb.ALL).collect()} for w in (small, large))
    assert a == b and len(a) == 400


def test_slices_hold_few_words(spark):
    gains = nb.Gains(pa.table({"entity": ["*", "*"], "place": pa.array([0, 1], pa.int32()), "word": ["a", "b"], "gain": [1.0, 2.0]}))
    batch = pa.RecordBatch.from_pydict({"key": [1, 2, 3, 4], "model_entity": ["*"] * 4, "words": [["a", "a", "x"], None, ["b"] * 9, ["a"]]})
    parts = list(nb._slices(batch, gains, 2, 4))
    assert [p.column("key").to_pylist() for p, *_ in parts] == [[1, 2], [3], [4]]
    assert [s.tolist() for _, _, s, _ in parts] == [[[2.0, 0.0], [0.0, 0.0]], [[0.0, 18.0]], [[1.0, 0.0]]]
    assert parts[0][3].to_pylist() == [[{"word": "x", "count": 1}], []]
