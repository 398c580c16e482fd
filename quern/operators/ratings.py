"""Rating statistics over a star schema of movies, ratings, users and tags.

Ratings are reduced to one row per join key before any join: the join then
carries one row per movie or user however often a popular one was rated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import text as tx
from quern.functions import time as tm

_PARTIAL = ("_min", "_sum", "_max", "_cnt")


def _partial(ratings: DataFrame, key: str) -> DataFrame:
    r = F.col("rating")
    return ratings.groupBy(key).agg(
        F.min(r).alias("_min"), F.sum(r).alias("_sum"), F.max(r).alias("_max"), F.count(r).alias("_cnt")
    )


def _final(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.min("_min").alias("min_rating"),
        (F.sum("_sum") / F.nullif(F.sum("_cnt"), F.lit(0))).alias("avg_rating"),
        F.max("_max").alias("max_rating"),
        F.sum("_cnt").alias("rating_cnt"),
    )


def movie_genres(movies: DataFrame) -> DataFrame:
    """One row per movie and genre; the list column goes away."""
    keep = [c for c in movies.columns if c != "genres"]
    return movies.select(*keep, F.explode(tx.pipe_list(F.col("genres"))).alias("genre"))


def genre_stats(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """min, avg, max and count of ratings per genre."""
    rated = movies.select("movie_id", "genres").join(_partial(ratings, "movie_id"), "movie_id")
    return _final(movie_genres(rated.select("genres", *_PARTIAL)), "genre")


def title_stats(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """min, avg, max and count of ratings per title."""
    rated = movies.select("movie_id", "title").join(_partial(ratings, "movie_id"), "movie_id")
    return _final(rated, "title")


def genres_above_average(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """Genres whose average beats the average of all ratings."""
    overall = ratings.agg(F.avg("rating").alias("overall")).scalar()
    return (
        genre_stats(movies, ratings)
        .where(F.col("avg_rating") > overall)
        .select("genre", "avg_rating", "rating_cnt")
    )


def user_scatter(users: DataFrame, ratings: DataFrame) -> DataFrame:
    """Average rating and number of ratings per e-mail address.

    ``ratings`` may be partial sums already (columns ``_min _sum _max _cnt``).
    """
    partial = ratings if "_cnt" in ratings.columns else _partial(ratings, "user_id")
    merged = partial.groupBy("user_id").agg(F.sum("_sum").alias("_sum"), F.sum("_cnt").alias("_cnt"))
    return (
        users.select("user_id", "email")
        .join(merged, "user_id")
        .groupBy("email")
        .agg(
            (F.sum("_sum") / F.nullif(F.sum("_cnt"), F.lit(0))).alias("avg_rating"),
            F.sum("_cnt").alias("count"),
        )
    )


def monthly_counts(ratings: DataFrame) -> DataFrame:
    """Ratings per year and month (both as text, written after counting)."""
    day = tm.epoch_day(F.col("timestamp"))
    counts = ratings.groupBy(F.year(day).alias("y"), F.month(day).alias("m")).count()
    return counts.select(
        F.col("y").cast("string").alias("year"), tm.two_digits(F.col("m")).alias("month"), "count"
    )


def release_lags(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """Number of ratings by years between release and rating (null: year unknown).

    Counted per movie and rating year first, then joined with the release year.
    """
    year = F.year(tm.epoch_day(F.col("timestamp")))
    yearly = ratings.groupBy("movie_id", year.alias("rating_year")).agg(F.count("*").alias("_n"))
    lag = tm.year_gap(F.col("rating_year"), F.col("year"))
    return (
        movies.select("movie_id", "year")
        .join(yearly, "movie_id")
        .groupBy(lag.alias("release_to_rating_year"))
        .agg(F.sum("_n").alias("count"))
        .select(
            "release_to_rating_year",
            F.when(F.col("release_to_rating_year").isNull(), F.lit(0)).otherwise(F.col("count")).alias("count"),
        )
    )


def known_lags(lags: DataFrame) -> DataFrame:
    """Without unknown years and without the lag -1."""
    lag = F.col("release_to_rating_year")
    return lags.where((lag != -1) & lag.isNotNull())


def rated_lags(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row per rating with its release lag."""
    year = F.year(tm.epoch_day(F.col("timestamp")))
    joined = movies.select("movie_id", "year").join(ratings.withColumn("_y", year), "movie_id")
    return joined.withColumn("release_to_rating_year", tm.year_gap(F.col("_y"), F.col("year"))).drop("_y")


def above_threshold(stats: DataFrame, min_average: float) -> DataFrame:
    """Rows with at least this average."""
    return stats.where(F.col("avg_rating") >= F.lit(min_average))
