"""Streams end with the batch result, also over several files and restarts."""

import random
from collections import Counter

from pyspark.sql import functions as F

from quern.functions import text as tx
from quern.operators import bayes as nb
from quern.operators import words as wd
from quern.sources import staging
from quern.sources.staging import fresh_path
from quern.streaming import scoring, word_counts
from quern.streaming.sources import file_stream

TEXTS = [(i, "n" if i % 2 else "m", f"w{i % 5} common w{i % 3}") for i in range(60)]
SCHEMA = "id BIGINT, e STRING, text STRING"


def test_word_counts_over_two_runs(spark):
    inbox, folder, state = (fresh_path(spark, n) for n in ("inbox", "counts", "state"))
    df = spark.createDataFrame(TEXTS, SCHEMA)
    words = tx.words(F.col("text"))
    for part in (df.where("id < 40").repartition(3), df.where("id >= 40").repartition(2)):
        part.write.mode("append").parquet(inbox)
        stream = file_stream(spark, inbox, SCHEMA, files_per_batch=1)
        word_counts.start_counts(stream, words, folder, state).awaitTermination()
    got = {r.word: r["count"] for r in word_counts.current_counts(spark, folder).collect()}
    assert got == {r.word: r["count"] for r in wd.word_counts(df, words).collect()}
    top = word_counts.top_words(spark, folder, 2).collect()
    assert (top[0].word, top[0]["count"]) == ("common", 60)


def test_totals_are_merged(spark, monkeypatch):
    monkeypatch.setattr(word_counts, "MERGE_EVERY", 2)
    inbox, folder, state = (fresh_path(spark, n) for n in ("inbox", "counts", "state"))
    df = spark.createDataFrame(TEXTS, SCHEMA)
    words = tx.words(F.col("text"))
    for k in range(5):
        df.where(f"id % 5 = {k}").coalesce(1).write.mode("append").parquet(inbox)
        stream = file_stream(spark, inbox, SCHEMA, files_per_batch=1)
        word_counts.start_counts(stream, words, folder, state).awaitTermination()
    word_counts.merge_before(spark, folder, 4)  # a repeated call changes nothing
    kept = [p for p in range(6) for kind in ("new", "merged") if staging.exists(spark, word_counts.batch_path(folder, p, kind))]
    assert kept == [3, 4]
    got = {r.word: r["count"] for r in word_counts.current_counts(spark, folder).collect()}
    assert got == {r.word: r["count"] for r in wd.word_counts(df, words).collect()}


def test_heads_hold_the_most_frequent_words(spark, monkeypatch):
    monkeypatch.setattr(word_counts, "HEAD_BUCKETS", 3)
    monkeypatch.setattr(word_counts, "HEAD_LEVELS", (2, 5))
    inbox, folder, state = (fresh_path(spark, n) for n in ("inbox", "counts", "state"))
    draw = random.Random(1)
    texts = [(i, "n", " ".join(f"w{int(draw.random() ** 2 * 60) + i // 40}" for _ in range(12))) for i in range(120)]
    words = tx.words(F.col("text"))
    for k in range(3):
        spark.createDataFrame(texts[k * 40 : k * 40 + 40], SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        word_counts.start_counts(file_stream(spark, inbox, SCHEMA, files_per_batch=1), words, folder, state).awaitTermination()
        totals = Counter(w for _, _, t in texts[: k * 40 + 40] for w in t.split())
        want = sorted(totals.items(), key=lambda wc: (-wc[1], wc[0]))
        for n in (1, 2, 5, 9):
            assert [(r.word, r["count"]) for r in word_counts.top_words(spark, folder, n).collect()] == want[:n]
    assert word_counts.last_head(spark, folder) == 2 and len(staging.children(spark, f"{folder}/_head")) == 2
    assert word_counts.top_candidates(spark, folder, 2).count() == 6 < word_counts.top_candidates(spark, folder, 9).count()
    plan = word_counts.top_candidates(spark, folder, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(level" in plan
    # A repeated batch, and one after its heads were lost half written, give the same heads.
    before = sorted(map(tuple, word_counts.read_head(spark, folder, 2).collect()))
    again = word_counts.current_counts(spark, folder).where("word in ('w3', 'w41')")
    staging.remove(spark, word_counts.head_path(folder, 2) + "/_SUCCESS")
    assert word_counts.last_head(spark, folder) == 1
    batch = spark.read.parquet(word_counts.batch_path(folder, 2))
    word_counts.keep_heads(batch.union(again), folder, 2)
    assert sorted(map(tuple, word_counts.read_head(spark, folder, 2).collect())) == before


def test_nothing_has_arrived(spark):
    folder = fresh_path(spark, "empty")
    assert word_counts.current_counts(spark, folder).count() == word_counts.top_words(spark, folder, 3).count() == 0
    assert scoring.predictions(spark, folder, "id BIGINT, prediction INT, batch_id BIGINT").columns == ["id", "prediction"]


def test_scores_equal_the_batch_job(spark):
    inbox, folder, state = (fresh_path(spark, n) for n in ("inbox", "scores", "state"))
    df = spark.createDataFrame(TEXTS, SCHEMA)
    words = tx.words(F.col("text"))
    train = df.where("e = 'n'").withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    weights = nb.weights(nb.fit(train, words, "y", entity="e"))
    df.repartition(3).write.parquet(inbox)
    stream = file_stream(spark, inbox, SCHEMA, files_per_batch=1)
    scoring.start_scoring(stream, "id", F.col("e"), words, weights, folder, state).awaitTermination()
    schema = "id BIGINT, model_entity STRING, prediction INT, score DOUBLE, batch_id BIGINT"
    got = scoring.predictions(spark, folder, schema)
    want = nb.classify(nb.with_model(df, weights, F.col("e")), "id", words, weights)
    assert got.count() == 60
    assert got.exceptAll(want.select(got.columns)).count() == 0
