"""Rating jobs: titles, genres, statistics, lags, tags, users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import hashing as hs
from quern.functions import text as tx
from quern.functions import time as tm
from quern.operators import ratings as rt
from quern.operators import relational as rel
from quern.operators.stats import histogram
from quern.plans import standins as st
from quern.plans.registry import job
from quern.sources.staging import staged
from quern.sources.tables import register, table

GENRE_STATS = f"""{st.MOVIES}, {st.RATINGS}, genre_ratings AS (
  SELECT genre, rating FROM ratings JOIN
    (SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM movies) USING (movie_id)),
stats AS (
  SELECT genre, min(rating) AS min_rating, round(avg(rating), 6) AS avg_rating,
         max(rating) AS max_rating, count(rating) AS rating_cnt
  FROM genre_ratings GROUP BY genre)"""


def _rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumn("avg_rating", F.round("avg_rating", 6))


@job(
    "genre_stats_top3",
    f"WITH {GENRE_STATS} SELECT * FROM stats ORDER BY avg_rating DESC, genre LIMIT 3",
)
def genre_stats_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = rt.genre_stats(st.movies(spark, sf_dir), st.ratings(spark, sf_dir))
    return rel.top(_rounded(stats), 3, F.desc("avg_rating"), "genre")


@job(
    "genre_stats_top3_by_count",
    f"WITH {GENRE_STATS} SELECT * FROM stats ORDER BY rating_cnt DESC, genre LIMIT 3",
)
def genre_stats_top3_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = rt.genre_stats(st.movies(spark, sf_dir), st.ratings(spark, sf_dir))
    return rel.top(_rounded(stats), 3, F.desc("rating_cnt"), "genre")


TITLE_STATS = f"""{st.PARSED_MOVIES}, {st.RATINGS}, stats AS (
  SELECT title, min(rating) AS min_rating, round(avg(rating), 6) AS avg_rating,
         max(rating) AS max_rating, count(rating) AS rating_cnt
  FROM parsed JOIN ratings USING (movie_id) GROUP BY title)"""


@job("title_stats", f"WITH {TITLE_STATS} SELECT * FROM stats")
def title_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = rt.title_stats(st.parsed_movies(spark, sf_dir), st.ratings(spark, sf_dir))
    return _rounded(stats).orderBy(F.desc("rating_cnt"), "title")


@job(
    "threshold_filters",
    f"""WITH {TITLE_STATS}
SELECT title, avg_rating, rating_cnt, rating_cnt >= 1000 AS often_rated
FROM stats WHERE avg_rating >= 25.5""",
)
def threshold_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles from an average on; the stricter rule (also a count) is a flag of the same pass."""
    stats = rt.title_stats(st.parsed_movies(spark, sf_dir), st.ratings(spark, sf_dir))
    return rt.above_threshold(_rounded(stats), 25.5).select(
        "title", "avg_rating", "rating_cnt", (F.col("rating_cnt") >= 1000).alias("often_rated")
    )


@job(
    "average_rating_hist",
    f"""WITH {TITLE_STATS}, ends AS (SELECT min(avg_rating) AS lo, max(avg_rating) AS hi FROM stats)
SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((avg_rating - lo) / ((hi - lo) / 50)), 49) END AS INT) AS bin,
       round(lo, 6) AS lo, round(hi, 6) AS hi, count(*) AS count
FROM stats, ends GROUP BY ALL""",
)
def average_rating_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50 equal bins over the average ratings of all titles."""
    stats = rt.title_stats(st.parsed_movies(spark, sf_dir), st.ratings(spark, sf_dir))
    stats = staged(_rounded(stats).where("rating_cnt >= 0").select("avg_rating"), "averages")
    hist = histogram(stats, "avg_rating", 50)
    return hist.select("bin", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "count")


@job(
    "title_year_parse",
    rf"""WITH {st.PARSED_MOVIES}
SELECT movie_id, regexp_extract(raw_title, '^(.+)\((\d{{4}})\)$', 1) AS strict_title, title, year
FROM movies JOIN parsed USING (movie_id)""",
)
def title_year_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("raw_title")
    return st.movies(spark, sf_dir).select(
        "movie_id",
        tx.strict_title(raw).alias("strict_title"),
        tx.clean_title(raw).alias("title"),
        tx.strict_year(raw).alias("year"),
    )


@job(
    "genre_list",
    f"WITH {st.MOVIES} SELECT DISTINCT unnest(string_split(genres, '|')) AS genre FROM movies",
)
def genre_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.movie_genres(st.movies(spark, sf_dir)).select("genre").distinct()


# The words part names are made of; they name the columns in the SQL twin.
GENRES = "anvil blue bolt cold gear gizmo hot large new old plate red ring rod small widget".split()
FLAGS = ", ".join(f"list_contains(string_split(genres, '|'), '{g}') AS \"{g}\"" for g in GENRES)


@job("genre_flags", f"WITH {st.MOVIES} SELECT movie_id, raw_title, {FLAGS} FROM movies")
def genre_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One boolean column per genre; the genre names become the schema, so they are read first.

    ``genre_pairs`` has the same facts as rows, for any number of genres.
    """
    movies = st.movies(spark, sf_dir)
    genres = rel.distinct_values(rt.movie_genres(movies), "genre")
    listed = movies.withColumn("genres_array", tx.pipe_list(F.col("genres")))
    flags = rel.membership_flags(listed, "genres_array", genres, skip=("(no genres listed)",))
    return flags.drop("genres", "genres_array")


@job(
    "genre_flag_vectors",
    f"""WITH {st.MOVIES}, pairs AS (SELECT DISTINCT movie_id, genre
  FROM (SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM movies) WHERE genre <> '(no genres listed)'),
codes AS (SELECT genre, row_number() OVER (ORDER BY genre) - 1 AS code FROM (SELECT DISTINCT genre FROM pairs))
SELECT movie_id, (SELECT count(*) FROM codes) AS size, coalesce(string_agg(code::VARCHAR, ',' ORDER BY code), '') AS indices
FROM movies LEFT JOIN pairs USING (movie_id) LEFT JOIN codes USING (genre) GROUP BY movie_id""",
)
def genre_flag_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flags of ``genre_flags`` as a sparse vector per movie; genres are numbered by a job and never collected."""
    genres = tx.pipe_list(F.col("genres"))
    vectors, _ = rel.flag_vectors(st.movies(spark, sf_dir), "movie_id", genres, skip=("(no genres listed)",))
    return vectors.withColumn("indices", F.array_join(F.transform("indices", lambda c: c.cast("string")), ","))


@job(
    "genre_pairs",
    f"""WITH {st.MOVIES} SELECT DISTINCT movie_id, genre
FROM (SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM movies) WHERE genre <> '(no genres listed)'""",
)
def genre_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The genres of each movie, one row a pair."""
    movies = st.movies(spark, sf_dir).select("movie_id", F.explode(F.array_distinct(tx.pipe_list(F.col("genres")))).alias("genre"))
    return movies.where("genre <> '(no genres listed)'")


MONTHS = f"""{st.RATINGS}, months AS (
  SELECT strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y') AS year,
         strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%m') AS month, count(*) AS count
  FROM ratings GROUP BY 1, 2)"""


@job("ratings_by_month", f"WITH {MONTHS} SELECT * FROM months")
def ratings_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.monthly_counts(st.ratings(spark, sf_dir)).orderBy("year", "month")


@job(
    "rating_times",
    f"""WITH {st.RATINGS}, t AS (
  SELECT movie_id, rating, strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS rated_at FROM ratings)
SELECT movie_id, rating, rated_at, rated_at[1:4] AS year, rated_at[6:7] AS month, rated_at[9:10] AS day FROM t""",
)
def rating_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rating with its date and time as text, and the parts of that text."""
    rated = st.ratings(spark, sf_dir).withColumn("rated_at", tm.epoch_text(F.col("timestamp")))
    return rated.drop("timestamp").withColumns(tm.text_parts(F.col("rated_at")))


@job(
    "fractional_year",
    f"""WITH {MONTHS} SELECT year || '-' || month AS label,
  round(CAST(year AS INT) + (CAST(month AS INT) - 1) / 12.0, 6) AS t, count FROM months""",
)
def fractional_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month label, position on a yearly axis and count."""
    months = rt.monthly_counts(st.ratings(spark, sf_dir))
    return months.select(
        F.concat("year", F.lit("-"), "month").alias("label"),
        F.round(tm.fractional_year(F.col("year"), F.col("month")), 6).alias("t"),
        "count",
    )


LAGS = f"""{st.PARSED_MOVIES}, {st.RATINGS}, lags AS (
  SELECT TRY_CAST(strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y') AS INT) - TRY_CAST(year AS INT)
           AS release_to_rating_year, movie_id, ts, rating
  FROM parsed JOIN ratings USING (movie_id)),
lag_counts AS (
  SELECT release_to_rating_year, count(release_to_rating_year) AS count FROM lags GROUP BY 1
  HAVING release_to_rating_year <> -1)"""


@job("release_lag_hist", f"WITH {LAGS} SELECT * FROM lag_counts")
def release_lag_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    lags = rt.release_lags(st.parsed_movies(spark, sf_dir), st.ratings(spark, sf_dir))
    return rt.known_lags(lags).orderBy("release_to_rating_year")


@job(
    "weighted_hist",
    f"""WITH {LAGS}, ends AS (
  SELECT min(release_to_rating_year) AS lo, max(release_to_rating_year) AS hi FROM lag_counts)
SELECT CAST(least(floor((release_to_rating_year - lo) / ((hi - lo) / 50.0)), 49) AS INT) AS bin,
  CAST(sum(count) AS BIGINT) AS weight FROM lag_counts, ends GROUP BY 1""",
)
def weighted_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50 equal bins over the lag years, each lag weighted by its number of ratings."""
    lags = rt.known_lags(rt.release_lags(st.parsed_movies(spark, sf_dir), st.ratings(spark, sf_dir)))
    lags = staged(lags, "lags")  # one row per lag, read twice below
    hist = histogram(lags, "release_to_rating_year", 50, weight="count")
    return hist.select("bin", F.col("weight").cast("bigint").alias("weight"))


@job(
    "sampled_lags",
    f"""WITH {LAGS}
SELECT movie_id, ts AS timestamp, rating, release_to_rating_year FROM lags
WHERE ('0x' || substr(md5(movie_id || '-' || ts || ':7'), 1, 8))::BIGINT % 1000 < 5""",
)
def sampled_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release lags of a keyed 0.5 % sample of the ratings; the sample is cut before the join."""
    ratings = st.ratings(spark, sf_dir)
    key = F.concat_ws("-", F.col("movie_id").cast("string"), F.col("timestamp").cast("string"))
    sample = ratings.where(hs.hash_bucket(key, 7, 1000) < 5)
    return rt.rated_lags(st.parsed_movies(spark, sf_dir), sample).select(
        "movie_id", "timestamp", "rating", "release_to_rating_year"
    )


@job(
    "genre_above_average",
    f"""WITH {st.MOVIES}, {st.RATINGS}
SELECT genre, round(avg(rating), 6) AS avg_rating, count(rating) AS rating_cnt
FROM ratings JOIN (SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM movies) USING (movie_id)
GROUP BY genre HAVING avg(rating) > (SELECT avg(rating) FROM ratings)""",
)
def genre_above_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rt.genres_above_average(st.movies(spark, sf_dir), st.ratings(spark, sf_dir))
    return _rounded(found).orderBy(F.desc("avg_rating"), "genre")


@job(
    "genre_above_average_sql",
    f"""WITH {st.MOVIES}, {st.RATINGS}
SELECT genre, round(avg(rating), 6) AS avg_rating, count(rating) AS rating_cnt
FROM ratings JOIN (SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM movies) USING (movie_id)
GROUP BY genre HAVING avg(rating) > (SELECT avg(rating) FROM ratings)""",
)
def genre_above_average_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through registered views and SQL text; statistics per movie come first here too."""
    register({"movie_table": st.movies(spark, sf_dir), "rating_table": st.ratings(spark, sf_dir)})
    return spark.sql(r"""
        WITH per_movie AS (
          SELECT movie_id, sum(rating) AS s, count(rating) AS n FROM rating_table GROUP BY movie_id),
        per_genre AS (
          SELECT genre, sum(s) / sum(n) AS avg_rating, sum(n) AS rating_cnt
          FROM movie_table JOIN per_movie USING (movie_id)
          LATERAL VIEW explode(split(genres, '\\|')) g AS genre
          GROUP BY genre HAVING sum(s) / sum(n) > (SELECT avg(rating) FROM rating_table))
        SELECT genre, round(avg_rating, 6) AS avg_rating, rating_cnt FROM per_genre
        ORDER BY avg_rating DESC, genre""")


@job(
    "tags_per_user",
    f"""WITH {st.USERS}, tags AS (
  SELECT o_custkey AS user_id, o_orderkey AS tag_id, o_orderpriority AS tag FROM orders)
SELECT email, string_agg(tag, ' ' ORDER BY tag_id) AS tag_list FROM users JOIN tags USING (user_id) GROUP BY email""",
)
def tags_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of a user in one text, in the order they were given; e-mails join after the reduction."""
    lists = rel.ordered_text(st.tags(spark, sf_dir), ["user_id"], "tag_id", "tag", " ", "tag_list")
    return st.users(spark, sf_dir).join(lists, "user_id").select("email", "tag_list")


@job(
    "transcript_per_conversation",
    "SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS transcript FROM conversations GROUP BY conv_id",
)
def transcript_per_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return rel.ordered_text(turns, ["conv_id"], "turn", "text", "\n", "transcript")


@job(
    "user_rating_scatter",
    f"""WITH {st.USERS}
SELECT email, round(avg(l_quantity), 6) AS avg_rating, count(l_quantity) AS count
FROM users JOIN orders ON user_id = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY email""",
)
def user_rating_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings are summed per order before they meet the order's user."""
    per_order = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum("l_quantity").alias("_sum"), F.count("l_quantity").alias("_cnt"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    partial = orders.join(per_order, "o_orderkey")
    return _rounded(rt.user_scatter(st.users(spark, sf_dir), partial)).orderBy(F.desc("avg_rating"), "email")


@job(
    "user_tags_sql",
    f"""WITH {st.USERS} SELECT email, o_orderkey AS tag_id, o_orderpriority AS tag
FROM users JOIN orders ON user_id = o_custkey""",
)
def user_tags_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and tags joined in SQL text over registered views, each column once."""
    register({"user_table": st.users(spark, sf_dir), "tag_table": st.tags(spark, sf_dir)})
    return spark.sql("SELECT u.email, t.tag_id, t.tag FROM user_table u JOIN tag_table t ON u.user_id = t.user_id")
