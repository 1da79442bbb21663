"""The rating questions Q1-Q5 over movie / rating / user text files.

Each function takes parsed frames (see ``sparktally.sources``) and returns
typed results; ``run_rating_report`` reads the files, renders the report
lines and writes them, replacing the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.functions.values import bucketize, in_synonyms
from sparktally.operators.joins import last_per_key
from sparktally.operators.ratings import rate_by_segment, rate_entities, rate_tags, rating_stats, top_rated
from sparktally.sinks import write_key_value
from sparktally.sinks.reports import (
    BAND_LABELS,
    band_report,
    best_movie_report,
    gender_report,
    genre_report,
    movie_report,
)
from sparktally.sources.delimited import read_movies, read_ratings, read_users

# Gender synonyms (names compared ignoring case, codes as is),
# age band edges (right-closed) and the minimum support of the best movie.
MALE_NAMES = ("M", "Male")
MALE_CODES = ("1",)
FEMALE_NAMES = ("F", "Female")
FEMALE_CODES = ("0",)
AGE_EDGES = (18, 35, 50)
AGE_COLUMNS = ("avg_0_18", "avg_18_35", "avg_35_50", "avg_50_plus")
BEST_MIN_SUPPORT = 5


def movie_ratings(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Q1: (movie_id, title, avg_rating, n) by movie id."""
    return rate_entities(ratings, movies)


def best_movie(ratings: DataFrame, movies: DataFrame, min_support: int = BEST_MIN_SUPPORT) -> DataFrame:
    """Q2: zero or one row, the best average among well-rated movies."""
    return top_rated(rating_stats(ratings), min_support, movies=movies)


def genre_ratings(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Q3: (genre, avg_rating, n) by genre."""
    return rate_tags(ratings, movies)


def gender_segments(users: DataFrame) -> DataFrame:
    """(user_id, segment) with the last line of a user winning; the
    segment is NULL for an unrecognised gender."""
    last = last_per_key(users, "user_id", ["gender"])
    g = F.col("gender")
    seg = (
        F.when(in_synonyms(g, MALE_NAMES, MALE_CODES), F.lit("male"))
        .when(in_synonyms(g, FEMALE_NAMES, FEMALE_CODES), F.lit("female"))
    )
    return last.select("user_id", seg.alias("segment"))


def age_segments(users: DataFrame) -> DataFrame:
    """(user_id, segment): age band of the last line of a user with a valid
    age; users without one are absent."""
    last = last_per_key(users.where(F.col("age").isNotNull()), "user_id", ["age"])
    return last.select("user_id", bucketize(F.col("age"), AGE_EDGES, BAND_LABELS).alias("segment"))


def gender_ratings(ratings: DataFrame, users: DataFrame, movies: DataFrame) -> DataFrame:
    """Q4: (movie_id, title, avg_male, avg_female)."""
    return rate_by_segment(ratings, gender_segments(users), ("male", "female"), movies)


def age_ratings(ratings: DataFrame, users: DataFrame, movies: DataFrame) -> DataFrame:
    """Q5: (movie_id, title, avg_0_18, avg_18_35, avg_35_50, avg_50_plus)."""
    return rate_by_segment(ratings, age_segments(users), BAND_LABELS, movies, names=AGE_COLUMNS)


def rating_report(
    spark: SparkSession,
    question: str,
    movies_path: str,
    ratings_paths: Sequence[str],
    users_path: str | None = None,
) -> DataFrame:
    """Report lines (key, value) of one question: ``movies`` (Q1 then the
    Q2 line), ``genres`` (Q3), ``gender`` (Q4) or ``age`` (Q5)."""
    movies = read_movies(spark, movies_path)
    ratings = read_ratings(spark, ratings_paths)
    if question == "movies":
        rated = movie_report(movie_ratings(ratings, movies))
        best = best_movie_report(best_movie(ratings, movies), BEST_MIN_SUPPORT)
        return rated.unionByName(best)
    if question == "genres":
        return genre_report(genre_ratings(ratings, movies))
    if users_path is None:
        raise ValueError(f"question {question!r} needs a users file")
    users = read_users(spark, users_path)
    if question == "gender":
        return gender_report(gender_ratings(ratings, users, movies))
    if question == "age":
        return band_report(age_ratings(ratings, users, movies), AGE_COLUMNS)
    raise ValueError(f"unknown question {question!r}")


def run_rating_report(
    spark: SparkSession,
    question: str,
    movies_path: str,
    ratings_paths: Sequence[str],
    out_path: str,
    users_path: str | None = None,
) -> None:
    """Write the report of one question as ``key<TAB>value`` lines,
    replacing ``out_path``. Each partition is one part file; the sorted
    result is range-partitioned, so reading the part files in name order
    gives the report order (the Q2 line, a union's last partition, comes
    last)."""
    lines = rating_report(spark, question, movies_path, ratings_paths, users_path)
    write_key_value(lines, out_path, "key", "value")
