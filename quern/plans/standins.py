"""Views of the given tables in the shape the jobs expect, and the same as SQL.

movies <- part, ratings <- lineitem, users <- customer, tags <- orders,
daily demand <- orders per day, energy <- yearly sales per nation,
exam and tweets <- documents with labels, books <- documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as tx
from quern.functions import time as tm
from quern.operators.prefix import positions
from quern.sources.tables import table, text_table

MOVIES = """movies AS (
  SELECT p_partkey AS movie_id, p_name || ' (' || CAST(1950 + p_size AS VARCHAR) || ')' AS raw_title,
         replace(p_name, ' ', '|') AS genres FROM part)"""


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("movie_id"),
        F.concat("p_name", F.lit(" ("), (F.lit(1950) + F.col("p_size")).cast("string"), F.lit(")")).alias(
            "raw_title"
        ),
        F.replace("p_name", F.lit(" "), F.lit("|")).alias("genres"),
    )


def parsed_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movies with title and release year taken from the raw title."""
    return movies(spark, sf_dir).select(
        "movie_id",
        tx.clean_title(F.col("raw_title")).alias("title"),
        tx.strict_year(F.col("raw_title")).alias("year"),
        "genres",
    )


PARSED_MOVIES = (
    MOVIES
    + r""", parsed AS (
  SELECT movie_id, genres,
         CASE WHEN regexp_extract(raw_title, '^(.*?)\s*\((\d{4})\)\s*$', 1) = '' THEN raw_title
              ELSE regexp_extract(raw_title, '^(.*?)\s*\((\d{4})\)\s*$', 1) END AS title,
         regexp_extract(raw_title, '^(.+)\((\d{4})\)$', 2) AS year
  FROM movies)"""
)

RATINGS = """ratings AS (
  SELECT l_partkey AS movie_id, l_quantity AS rating,
         CAST(epoch(l_shipdate) AS BIGINT) AS ts FROM lineitem)"""


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("movie_id"),
        F.col("l_quantity").alias("rating"),
        tm.utc_epoch(F.col("l_shipdate")).alias("timestamp"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lower("c_name"), F.lit("@movies.com")).alias("email"),
    )


USERS = "users AS (SELECT c_custkey AS user_id, lower(c_name) || '@movies.com' AS email FROM customer)"


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("tag_id"),
        F.col("o_orderpriority").alias("tag"),
    )


def energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """country, year, population (orders) and demand (sales); demand is null for a fixed choice of country and year.

    Orders are reduced to one row per customer and year before the joins.
    """
    yearly = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"))
        .agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        yearly.join(customer, "c_custkey")
        .groupBy("c_nationkey", "year")
        .agg(F.sum("n").alias("population"), F.sum("s").alias("s"))
        .join(nation, "c_nationkey")
        .select(
            F.col("n_name").alias("country"),
            "year",
            F.col("population").cast("double").alias("population"),
            F.when(F.length("n_name") + F.col("year") % 7 != 10, F.col("s").cast("double")).alias("electricity_demand"),
        )
    )


ENERGY = """energy AS (
  SELECT n_name AS country, CAST(year(o_orderdate) AS INT) AS year, CAST(count(*) AS DOUBLE) AS population,
         CASE WHEN length(n_name) + year(o_orderdate) % 7 <> 10
              THEN CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) END AS electricity_demand
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_name, year(o_orderdate))"""


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order day: running number ``instant``, calendar columns, weather-like measures, ``cnt``.

    The table has one row per calendar day whatever the number of orders. Days
    are numbered year by year, so no window covers the whole series.
    """
    day = F.col("o_orderdate").cast("date")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    daily = (
        table(spark, sf_dir, "orders")
        .groupBy(day.alias("dteday"))
        .agg(
            F.count("*").alias("cnt"),
            F.pmod(F.sum("o_custkey"), F.lit(3)).alias("_w"),
            (F.sum(price).cast("double") / F.count("*") / F.lit(500000.0)).alias("temp"),
            (F.max("o_totalprice") / F.lit(500000.0)).alias("hum"),
            (F.min("o_totalprice") / F.lit(500000.0)).alias("windspeed"),
        )
    )
    numbered = positions(daily, "dteday", slot=F.year("dteday"), name="instant")
    weekday = F.dayofweek("dteday") - 1
    return numbered.select(
        F.col("instant").cast("bigint").alias("instant"),
        "dteday",
        F.quarter("dteday").alias("season"),
        F.year("dteday").alias("yr"),
        F.month("dteday").alias("mnth"),
        weekday.alias("weekday"),
        F.when(weekday.between(1, 5), 1).otherwise(0).alias("workingday"),
        (F.col("_w") + 1).cast("int").alias("weathersit"),
        "temp",
        "hum",
        "windspeed",
        "cnt",
    )


DAYS = """days AS (
  SELECT row_number() OVER (ORDER BY CAST(o_orderdate AS DATE)) AS instant,
         CAST(o_orderdate AS DATE) AS dteday,
         CAST(quarter(CAST(o_orderdate AS DATE)) AS INT) AS season,
         CAST(year(CAST(o_orderdate AS DATE)) AS INT) AS yr,
         CAST(month(CAST(o_orderdate AS DATE)) AS INT) AS mnth,
         CAST(dayofweek(CAST(o_orderdate AS DATE)) AS INT) AS weekday,
         CAST(CASE WHEN dayofweek(CAST(o_orderdate AS DATE)) BETWEEN 1 AND 5 THEN 1 ELSE 0 END AS INT)
           AS workingday,
         CAST(1 + sum(o_custkey) % 3 AS INT) AS weathersit,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 500000.0 AS temp,
         max(o_totalprice) / 500000.0 AS hum,
         min(o_totalprice) / 500000.0 AS windspeed,
         count(*) AS cnt
  FROM orders GROUP BY CAST(o_orderdate AS DATE))"""


def exam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: length, word count, a date, and the 0/1 result.

    The documents are joined after the text was reduced to its word count.
    """
    docs = text_table(spark, sf_dir, "documents").select(
        "doc_id",
        "n_chars",
        F.size(tx.words(F.col("text"))).alias("n_words"),
        F.date_add(F.lit("2016-01-14").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("exam_day"),
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("result"))
    return docs.join(labels, "doc_id")


DUCK_WORDS = r"[w FOR w IN regexp_split_to_array(text, '[\s\x0b\x1c-\x1f\x{85}\pZ]+') IF w <> '']"
DUCK_TOKENS = r"[w FOR w IN regexp_split_to_array(lower(text), '[\s\x0b[:punct:]—…”„]+') IF w <> '']"

EXAM = f"""exam AS (
  SELECT doc_id, n_chars, CAST(len({DUCK_WORDS}) AS INT) AS n_words,
         CAST(DATE '2016-01-14' + CAST(doc_id % 30 AS INT) AS DATE) AS exam_day, quality AS result
  FROM documents JOIN labels USING (doc_id))"""


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, entity, sentiment, text of the labelled documents."""
    docs = text_table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("entity"), "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("sentiment"))
    return docs.join(labels, "doc_id")


def tweet_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, entity, sentiment, word_count: texts become numbers before they meet the labels."""
    docs = text_table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("entity"), F.size(tx.words(F.col("text"))).alias("word_count")
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("sentiment"))
    return docs.join(labels, "doc_id").select("doc_id", "entity", "sentiment", "word_count")


TWEETS = """tweets AS (
  SELECT doc_id, source AS entity, quality AS sentiment, text
  FROM documents JOIN labels USING (doc_id))"""


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """author (language), work (source), content."""
    return text_table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("author"), F.col("source").alias("work"), F.col("text").alias("content")
    )
