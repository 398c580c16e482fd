"""Word, HTML and naive Bayes jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as tx
from quern.operators import bayes as nb
from quern.operators import metrics as mt
from quern.operators import relational as rel
from quern.operators import sampling as sp
from quern.operators import words as wd
from quern.plans import standins as st
from quern.plans.registry import job
from quern.sources.staging import staged
from quern.sources.tables import table, text_table

WORDS, TOKENS = st.DUCK_WORDS, st.DUCK_TOKENS


@job(
    "avg_words_by_work",
    """SELECT lang AS author, source AS work, round(avg(len(string_split(text, ' '))), 6) AS avg_words,
  count(*) AS count FROM documents GROUP BY lang, source""",
)
def avg_words_by_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = st.books(spark, sf_dir)
    return books.groupBy("author", "work").agg(
        F.round(F.avg(tx.blank_count_words(F.col("content"))), 6).alias("avg_words"),
        F.count("*").alias("count"),
    )


@job("author_works", "SELECT DISTINCT lang AS author, source AS work FROM documents")
def author_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.books(spark, sf_dir).select("author", "work").distinct()


@job(
    "entity_sentiment_counts",
    f"WITH {st.TWEETS} SELECT entity, sentiment, count(*) AS count FROM tweets GROUP BY ALL",
)
def entity_sentiment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.tweets(spark, sf_dir).groupBy("entity", "sentiment").count()


@job(
    "words_by_entity_sentiment",
    f"""WITH {st.TWEETS} SELECT entity, sentiment, CAST(sum(len({WORDS})) AS BIGINT) AS word_count
FROM tweets GROUP BY ALL""",
)
def words_by_entity_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = st.tweet_lengths(spark, sf_dir)
    return counted.groupBy("entity", "sentiment").agg(F.sum("word_count").alias("word_count"))


@job(
    "entity_filter",
    f"WITH {st.TWEETS} SELECT doc_id, entity, sentiment, len({WORDS})::INT AS word_count FROM tweets WHERE entity = 'src3'",
)
def entity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.tweet_lengths(spark, sf_dir).where(F.col("entity") == "src3")


@job("word_explode", f"SELECT unnest({WORDS}) AS word FROM conversations")
def word_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wd.explode_words(text_table(spark, sf_dir, "conversations"), tx.words(F.col("text")))


@job(
    "explode_keep_parent",
    f"""SELECT conv_id, turn, role, CAST(length(text) AS INT) AS n_chars, unnest({WORDS}) AS word
FROM conversations""",
)
def explode_keep_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = text_table(spark, sf_dir, "conversations").withColumn("n_chars", F.length("text"))
    return wd.explode_words(turns, tx.words(F.col("text")), ["conv_id", "turn", "role", "n_chars"])


DOC_WORDS = f"""counts AS (
  SELECT word, count(*) AS count FROM (SELECT unnest({WORDS}) AS word FROM documents) GROUP BY word)"""


@job("word_top10", f"WITH {DOC_WORDS} SELECT * FROM counts ORDER BY count DESC, word LIMIT 10")
def word_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = wd.word_counts(text_table(spark, sf_dir, "documents"), tx.words(F.col("text")))
    return rel.top(counts, 10, F.desc("count"), "word")


@job("word_bottom", f"WITH {DOC_WORDS} SELECT * FROM counts ORDER BY count, word DESC LIMIT 19 OFFSET 1")
def word_bottom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 19 rarest words but one: places -20 to -2 of the ranking by count."""
    counts = wd.word_counts(text_table(spark, sf_dir, "documents"), tx.words(F.col("text")))
    return rel.top(counts, 19, "count", F.desc("word"), skip=1)


HTML_TEXT = r"""regexp_replace(html, '<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|</?[a-z][^>"'']*(?:"[^"]*"[^>"'']*|''[^'']*''[^>"'']*)*>|<[/a-z!?][^>]*>', ' ', 'gis')"""
for _name, _sign in {"lt": "<", "gt": ">", "quot": '"', "copy": "©", "middot": "·", "nbsp": " ", "amp": "&"}.items():
    HTML_TEXT = f"replace({HTML_TEXT}, '&{_name};', '{_sign}')"
HTML_CLEAN = HTML_TEXT
for _pattern in (r'[#",!?;-<>/\\*&-]', r"\[[^\]]*\]", r"[:.+=()–©°′″•↑—]", r"\p{Nd}+\.?\p{Nd}*"):
    HTML_CLEAN = f"regexp_replace({HTML_CLEAN}, '{_pattern}', ' ', 'g')"
PAGE_WORDS = f"""page_text AS (SELECT page_id, {HTML_CLEAN} AS text FROM pages),
counts AS (SELECT word, count(*) AS count FROM (SELECT unnest({WORDS}) AS word FROM page_text) GROUP BY word)"""


@job("html_word_top10", f"WITH {PAGE_WORDS} SELECT * FROM counts ORDER BY count DESC, word LIMIT 10")
def html_word_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = wd.word_counts(text_table(spark, sf_dir, "pages"), tx.html_words(F.col("html")))
    return rel.top(counts, 10, F.desc("count"), "word")


@job("html_word_counts", f"WITH {PAGE_WORDS} SELECT * FROM counts")
def html_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wd.word_counts(text_table(spark, sf_dir, "pages"), tx.html_words(F.col("html")))


@job("page_text", f"SELECT page_id, {HTML_TEXT} AS text FROM pages")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_table(spark, sf_dir, "pages").select("page_id", tx.html_text(F.col("html")).alias("text"))


@job(
    "word_tokens_2plus",
    r"""SELECT word, count(*) AS count FROM (
  SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS word FROM documents) GROUP BY word""",
)
def word_tokens_2plus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wd.word_counts(text_table(spark, sf_dir, "documents"), tx.tokens_2plus(F.col("text")))


TERMS = f"""toks AS (SELECT doc_id, unnest({TOKENS}) AS word FROM documents),
bag AS (SELECT doc_id, word, count(*) AS count FROM toks GROUP BY ALL),
terms AS (
  SELECT word, sum(count) AS n, count(*) AS df FROM bag GROUP BY word HAVING count(*) >= 2
  ORDER BY n DESC, word LIMIT 10000)"""


@job("vocabulary", f"WITH {TERMS} SELECT word, CAST(n AS BIGINT) AS n, df FROM terms")
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wd.vocabulary(text_table(spark, sf_dir, "documents"), tx.tokens(F.col("text")), 10_000, 2)


@job("doc_term_counts", f"WITH {TERMS} SELECT doc_id, word, count FROM bag SEMI JOIN terms USING (word)")
def doc_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_table(spark, sf_dir, "documents")
    bag, _ = wd.bag_of(docs, "doc_id", tx.tokens(F.col("text")), 10_000, 2)
    return bag


@job(
    "tfidf_optional",
    f"""WITH {TERMS} SELECT doc_id, word, count,
  round(count * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS tf_idf
FROM bag JOIN terms USING (word)""",
)
def tfidf_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_table(spark, sf_dir, "documents")
    bag, terms = wd.bag_of(docs, "doc_id", tx.tokens(F.col("text")), 10_000, 2)
    weights = wd.tf_idf(bag, "doc_id", terms, docs)
    return weights.withColumn("tf_idf", F.round("tf_idf", 6))


# Author = language, all words, smoothing 0.2.
AUTHOR_BAYES = f"""toks AS (SELECT lang AS label, unnest({TOKENS}) AS word FROM documents),
n AS (SELECT label, word, count(*) AS n FROM toks GROUP BY ALL),
totals AS (SELECT label, sum(n) AS words FROM n GROUP BY label),
v AS (SELECT count(DISTINCT word) AS v FROM n),
sizes AS (SELECT lang AS label, count(*) AS docs FROM documents GROUP BY lang)"""


def _author_model(spark: SparkSession, sf_dir: str) -> nb.BayesModel:
    return nb.fit(st.books(spark, sf_dir), tx.tokens(F.col("content")), "author", smoothing=0.2)


@job(
    "nb_theta",
    f"""WITH {AUTHOR_BAYES} SELECT label, word, n, round(ln((n + 0.2) / (words + 0.2 * v)), 6) AS log_theta
FROM n JOIN totals USING (label), v""",
)
def nb_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    theta = _author_model(spark, sf_dir).theta
    return theta.select("label", "word", "n", F.round("log_theta", 6).alias("log_theta"))


@job(
    "nb_prior",
    f"""WITH {AUTHOR_BAYES} SELECT label, docs, CAST(words AS BIGINT) AS words, v AS vocabulary,
  round(ln((docs + 0.2) / (sum(docs) OVER () + 0.2 * count(*) OVER ())), 6) AS log_prior,
  round(ln(0.2 / (words + 0.2 * v)), 6) AS log_default
FROM sizes JOIN totals USING (label), v""",
)
def nb_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _author_model(spark, sf_dir).classes.select(
        "label",
        "docs",
        "words",
        "vocabulary",
        F.round("log_prior", 6).alias("log_prior"),
        F.round("log_default", 6).alias("log_default"),
    )


@job(
    "nb_classify",
    f"""WITH {AUTHOR_BAYES}, theta AS (
  SELECT label, word, ln((n + 0.2) / (words + 0.2 * v)) - ln(0.2 / (words + 0.2 * v)) AS gain
  FROM n JOIN totals USING (label), v),
prior AS (
  SELECT label, ln((docs + 0.2) / (sum(docs) OVER () + 0.2 * count(*) OVER ())) AS log_prior,
         ln(0.2 / (words + 0.2 * v)) AS log_default
  FROM sizes JOIN totals USING (label), v),
doc_words AS (SELECT doc_id, unnest({TOKENS}) AS word FROM documents),
known AS (SELECT doc_id, count(*) AS known FROM doc_words SEMI JOIN n USING (word) GROUP BY doc_id),
gains AS (SELECT doc_id, label, sum(gain) AS gain FROM doc_words JOIN theta USING (word) GROUP BY ALL),
scored AS (
  SELECT doc_id, label, round(log_prior + coalesce(known, 0) * log_default + coalesce(gain, 0), 6) AS score
  FROM documents CROSS JOIN prior LEFT JOIN known USING (doc_id) LEFT JOIN gains USING (doc_id, label))
SELECT doc_id, label AS prediction, score FROM scored
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) = 1""",
)
def nb_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = staged(st.books(spark, sf_dir).select("doc_id", "author", tx.tokens(F.col("content")).alias("words")), "book-words")
    model = nb.weights(nb.fit(docs, F.col("words"), "author", smoothing=0.2))
    # No author has a model of its own: all documents use the one over all rows.
    return nb.classify(docs, "doc_id", F.col("words"), model, entity=nb.ALL).drop("model_entity")


# One model per entity plus one over everything, words of two or more characters, class shares unsmoothed.
PLUS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
ENTITY_BAYES = f"""{st.TWEETS}, both_keys AS (
  SELECT lower(entity) AS entity, sentiment AS label, text FROM tweets
  UNION ALL SELECT '*', sentiment, text FROM tweets),
n AS (SELECT entity, label, word, count(*) AS n
      FROM (SELECT entity, label, unnest({PLUS}) AS word FROM both_keys) GROUP BY ALL),
totals AS (SELECT entity, label, sum(n) AS words FROM n GROUP BY ALL),
v AS (SELECT entity, count(DISTINCT word) AS v FROM n GROUP BY entity),
sizes AS (SELECT entity, label, count(*) AS docs FROM both_keys GROUP BY ALL),
classes AS (
  SELECT entity, label, docs, coalesce(words, 0) AS words, v,
         ln(docs / sum(docs) OVER (PARTITION BY entity)) AS log_prior,
         ln(1 / (coalesce(words, 0) + v)) AS log_default
  FROM sizes LEFT JOIN totals USING (entity, label) JOIN v USING (entity))"""


def _entity_fit(tweets: DataFrame, words: Column) -> nb.BayesModel:
    return nb.fit(tweets, words, "sentiment", entity="entity", smoothing=1.0, prior_smoothing=0.0)


def _entity_model(spark: SparkSession, sf_dir: str) -> nb.BayesModel:
    return _entity_fit(st.tweets(spark, sf_dir), tx.tokens_2plus(F.col("text")))


@job(
    "nb_per_entity",
    f"""WITH {ENTITY_BAYES} SELECT entity, label, docs, CAST(words AS BIGINT) AS words, v AS vocabulary,
  round(log_prior, 6) AS log_prior, round(log_default, 6) AS log_default FROM classes""",
)
def nb_per_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = _entity_model(spark, sf_dir).classes.drop("place", "rows")
    return classes.withColumns({c: F.round(c, 6) for c in ("log_prior", "log_default")})


@job(
    "nb_fallback",
    f"""WITH {ENTITY_BAYES}, texts AS (
  SELECT 'd' || doc_id AS text_id, source AS entity, text FROM documents
  UNION ALL SELECT 'c' || conv_id || '/' || turn, role, text FROM conversations),
asked AS (
  SELECT text_id, text, CASE WHEN lower(entity) IN (SELECT entity FROM classes) THEN lower(entity) ELSE '*' END
    AS model_entity FROM texts),
doc_words AS (SELECT text_id, model_entity, unnest({PLUS}) AS word FROM asked),
vocab AS (SELECT DISTINCT entity AS model_entity, word FROM n),
known AS (SELECT text_id, count(*) AS known FROM doc_words SEMI JOIN vocab USING (model_entity, word) GROUP BY ALL),
theta AS (
  SELECT entity AS model_entity, label, word, ln((n + 1) / (words + v)) - log_default AS gain
  FROM n JOIN classes USING (entity, label)),
gains AS (
  SELECT text_id, label, sum(gain) AS gain FROM doc_words JOIN theta USING (model_entity, word) GROUP BY ALL),
scored AS (
  SELECT text_id, model_entity, c.label,
         round(log_prior + coalesce(known, 0) * log_default + coalesce(gain, 0), 6) AS score
  FROM asked JOIN classes c ON model_entity = c.entity
  LEFT JOIN known USING (text_id) LEFT JOIN gains g USING (text_id, label))
SELECT text_id, model_entity, label AS prediction, score FROM scored
QUALIFY row_number() OVER (PARTITION BY text_id ORDER BY score DESC, label) = 1""",
)
def nb_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and turns; texts whose entity has no model of its own use the one under ``*``."""
    model = nb.weights(_entity_model(spark, sf_dir))
    docs = text_table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("text_id"), F.col("source").alias("entity"), "text"
    )
    turns = text_table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("/"), "turn").alias("text_id"), F.col("role").alias("entity"), "text"
    )
    asked = nb.with_model(docs.unionByName(turns), model, F.col("entity"))
    return nb.classify(asked, "text_id", tx.tokens_2plus(F.col("text")), model)


def _report_sql(predicted: str, keys: str) -> str:
    """SQL: class metrics per key of a table with label and prediction, both 0 or 1."""
    return f"""cells AS (
  SELECT {keys}, c.class, count(*) FILTER (label = c.class) AS support, count(*) FILTER (prediction = c.class) AS predicted,
         count(*) FILTER (label = c.class AND prediction = c.class) AS tp
  FROM {predicted}, (SELECT unnest([0, 1]) AS class) c GROUP BY {keys}, c.class),
rates AS (SELECT *, coalesce(tp / nullif(predicted, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r,
  coalesce(2 * tp / nullif(predicted + support, 0), 0) AS f FROM cells WHERE predicted + support > 0)
SELECT {keys}, round(sum(tp) / sum(support), 6) AS accuracy, round(sum(support * p) / sum(support), 6) AS weighted_precision,
  round(sum(support * r) / sum(support), 6) AS weighted_recall, round(sum(support * f) / sum(support), 6) AS weighted_f1
FROM rates GROUP BY {keys}"""


def _report(found: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    summary = mt.class_summary(mt.per_class(mt.confusion(found, "label", "prediction", keys), keys), keys)
    names = ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")
    return summary.select(*keys, *[F.round(n, 6).alias(n) for n in names])


@job(
    "nb_folds",
    f"""WITH {st.TWEETS}, k AS (SELECT CAST(unnest(range(1, 11)) AS INT) AS fold),
f AS (SELECT doc_id, sentiment AS label, text, ntile(10) OVER (PARTITION BY sentiment ORDER BY md5(doc_id || ':9')) AS own
      FROM tweets),
toks AS (SELECT doc_id, label, own, unnest({PLUS}) AS word FROM f),
n AS (SELECT fold, label, word, count(*) AS n FROM toks, k WHERE own <> fold GROUP BY ALL),
totals AS (SELECT fold, label, sum(n) AS words FROM n GROUP BY ALL),
v AS (SELECT fold, count(DISTINCT word) AS v FROM n GROUP BY fold),
sizes AS (SELECT fold, label, count(*) AS docs FROM f, k WHERE own <> fold GROUP BY ALL),
classes AS (
  SELECT fold, label, words, v, ln(docs / sum(docs) OVER (PARTITION BY fold)) AS log_prior, ln(1 / (words + v)) AS log_default
  FROM sizes JOIN totals USING (fold, label) JOIN v USING (fold)),
theta AS (
  SELECT fold, label, word, ln((n + 1) / (words + v)) - log_default AS gain FROM n JOIN classes USING (fold, label)),
known AS (SELECT doc_id, fold, count(*) AS known FROM toks JOIN (SELECT DISTINCT fold, word FROM n) USING (word) GROUP BY ALL),
gains AS (SELECT doc_id, fold, t.label, sum(gain) AS gain FROM toks JOIN theta t USING (word) GROUP BY ALL),
scored AS (
  SELECT doc_id, f.label, own, c.fold, c.label AS class,
         round(log_prior + coalesce(known, 0) * log_default + coalesce(gain, 0), 6) AS score
  FROM f CROSS JOIN classes c LEFT JOIN known USING (doc_id, fold)
  LEFT JOIN gains g ON g.doc_id = f.doc_id AND g.fold = c.fold AND g.label = c.label),
found AS (SELECT fold, CASE WHEN own = fold THEN 'test' ELSE 'train' END AS part, label, class AS prediction FROM scored
  QUALIFY row_number() OVER (PARTITION BY doc_id, fold ORDER BY score DESC, class) = 1),
{_report_sql("found", "fold, part")}""",
)
def nb_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten models, each trained without one fold, measured on that fold and on the others."""
    tweets = sp.stratified_folds(st.tweets(spark, sf_dir), "doc_id", "sentiment", 10, seed=9)
    tweets = staged(tweets.select("doc_id", "sentiment", "fold", tx.tokens_2plus(F.col("text")).alias("words")), "tweet-folds")
    model = nb.weights(nb.fit_folds(tweets, F.col("words"), "sentiment", "fold", 10, prior_smoothing=0.0))
    asked = tweets.withColumn("model_fold", F.explode(F.sequence(F.lit(1), F.lit(10))))
    part = F.when(F.col("fold") == F.col("model_fold"), "test").otherwise("train")
    told = F.struct(F.col("model_fold").alias("fold"), part.alias("part"), F.col("sentiment").alias("label"))
    asked = asked.select(told.alias("ask"), F.col("model_fold").cast("string").alias("model_entity"), "words")
    found = nb.classify(asked, "ask", F.col("words"), model)
    return _report(found.select("ask.*", "prediction"), ("fold", "part"))


@job(
    "nb_entity_report",
    f"""WITH {ENTITY_BAYES}, asked AS (
  SELECT doc_id, sentiment AS label, text, unnest([lower(entity), '*']) AS model_entity FROM tweets),
doc_words AS (SELECT doc_id, model_entity, unnest({PLUS}) AS word FROM asked),
vocab AS (SELECT DISTINCT entity AS model_entity, word FROM n),
known AS (SELECT doc_id, model_entity, count(*) AS known FROM doc_words SEMI JOIN vocab USING (model_entity, word) GROUP BY ALL),
theta AS (
  SELECT entity AS model_entity, label, word, ln((n + 1) / (words + v)) - log_default AS gain
  FROM n JOIN classes USING (entity, label)),
gains AS (
  SELECT doc_id, model_entity, label, sum(gain) AS gain FROM doc_words JOIN theta USING (model_entity, word) GROUP BY ALL),
scored AS (
  SELECT doc_id, a.label, model_entity, c.label AS class,
         round(log_prior + coalesce(known, 0) * log_default + coalesce(gain, 0), 6) AS score
  FROM asked a JOIN classes c ON model_entity = c.entity LEFT JOIN known USING (doc_id, model_entity)
  LEFT JOIN gains g ON g.doc_id = a.doc_id AND g.model_entity = c.entity AND g.label = c.label),
found AS (SELECT model_entity, label, class AS prediction FROM scored
  QUALIFY row_number() OVER (PARTITION BY doc_id, model_entity ORDER BY score DESC, class) = 1),
{_report_sql("found", "model_entity")}""",
)
def nb_entity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class metrics of every entity's model on its own documents, and of the one over all rows on all of them."""
    tweets = st.tweets(spark, sf_dir).select("entity", "sentiment", tx.tokens_2plus(F.col("text")).alias("words"))
    tweets = staged(tweets, "tweet-words")
    model = nb.weights(_entity_fit(tweets, F.col("words")))
    both = F.explode(F.array(F.lower("entity"), F.lit(nb.ALL))).alias("model_entity")
    asked = tweets.select(F.struct(F.col("sentiment").alias("label")).alias("ask"), "words", both)
    found = nb.classify(asked, "ask", F.col("words"), model)
    return _report(found.select("ask.*", "model_entity", "prediction"), ("model_entity",))
