"""Streaming jobs over the given tables; their results equal the batch jobs'."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as tx
from quern.operators import bayes as nb
from quern.plans import standins as st
from quern.plans.registry import job
from quern.plans.texts import ENTITY_BAYES, PLUS
from quern.sources.staging import fresh_path
from quern.sources.tables import table, table_path
from quern.streaming import scoring, word_counts
from quern.streaming.sources import file_stream


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # As a pattern the path may be one file or a folder of files.
    pattern = table_path(sf_dir, name).replace(".parquet", ".parque[t]")
    return file_stream(spark, pattern, table(spark, sf_dir, name).schema, files_per_batch=1000)


@job(
    "word_count_stream",
    f"""SELECT word, count(*) AS count FROM (SELECT unnest({st.DUCK_WORDS}) AS word FROM conversations)
GROUP BY word""",
)
def word_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "word-counts")
    turns = _stream(spark, sf_dir, "conversations")
    word_counts.start_counts(turns, tx.words(F.col("text")), folder, fresh_path(spark, "word-state")).awaitTermination()
    return word_counts.current_counts(spark, folder)


@job(
    "word_top10_stream",
    f"""SELECT word, count(*) AS count FROM (SELECT unnest({st.DUCK_WORDS}) AS word FROM conversations)
GROUP BY word ORDER BY count DESC, word LIMIT 10""",
)
def word_top10_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent words of the running counts."""
    folder = fresh_path(spark, "word-counts")
    turns = _stream(spark, sf_dir, "conversations")
    word_counts.start_counts(turns, tx.words(F.col("text")), folder, fresh_path(spark, "word-state")).awaitTermination()
    return word_counts.top_words(spark, folder, 10)


@job(
    "score_stream",
    f"""WITH {ENTITY_BAYES}, texts AS (
  SELECT conv_id || '/' || turn AS text_id, text FROM conversations),
doc_words AS (SELECT text_id, unnest({PLUS}) AS word FROM texts),
vocab AS (SELECT DISTINCT word FROM n WHERE entity = '*'),
known AS (SELECT text_id, count(*) AS known FROM doc_words SEMI JOIN vocab USING (word) GROUP BY ALL),
theta AS (
  SELECT label, word, ln((n + 1) / (words + v)) - log_default AS gain
  FROM n JOIN classes USING (entity, label) WHERE entity = '*'),
gains AS (SELECT text_id, label, sum(gain) AS gain FROM doc_words JOIN theta USING (word) GROUP BY ALL),
scored AS (
  SELECT text_id, c.label, round(log_prior + coalesce(known, 0) * log_default + coalesce(gain, 0), 6) AS score
  FROM texts CROSS JOIN (SELECT * FROM classes WHERE entity = '*') c
  LEFT JOIN known USING (text_id) LEFT JOIN gains g USING (text_id, label))
SELECT text_id, '*' AS model_entity, label AS prediction, score FROM scored
QUALIFY row_number() OVER (PARTITION BY text_id ORDER BY score DESC, label) = 1""",
)
def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns scored as they arrive with the models fitted on the labelled documents."""
    words = tx.tokens_2plus(F.col("text"))
    model = nb.fit(
        st.tweets(spark, sf_dir), words, "sentiment", entity="entity", smoothing=1.0, prior_smoothing=0.0
    )
    turns = _stream(spark, sf_dir, "conversations").select(
        F.concat("conv_id", F.lit("/"), "turn").alias("text_id"), F.col("role").alias("entity"), "text"
    )
    folder = fresh_path(spark, "turn-scores")
    query = scoring.start_scoring(
        turns, "text_id", F.col("entity"), words, nb.weights(model), folder, fresh_path(spark, "score-state")
    )
    query.awaitTermination()
    return scoring.predictions(
        spark, folder, "text_id STRING, model_entity STRING, prediction INT, score DOUBLE, batch_id BIGINT"
    )
