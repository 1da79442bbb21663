"""Readers for headerless delimited text.

Two families:

- comma-separated *lines* parsed positionally (movies, ratings, users):
  every field is trimmed the Java way, a line with too few fields is
  dropped, and numbers that do not parse become NULL instead of failing;
- ``PigStorage``-style loads with a declared all-string schema
  (``read_delimited``): empty field -> NULL, short row padded with NULL,
  extra fields cut, no quoting.

Each reader returns a plain DataFrame; the scan is split by Spark like any
text source, so the readers scale with the number of files and their size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktally.functions.text import java_trim
from sparktally.functions.values import safe_double, safe_int, split_fields, strip_trailing

MOVIES_SCHEMA = "movie_id string, title string, genres string"
RATINGS_SCHEMA = "user_id string, movie_id string, rating double, ts long"
USERS_SCHEMA = "user_id string, gender string, age int, occupation string, zip string"
REVIEW_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "review", "category", "aspect", "sentiment")]
)
TOKENS_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "word", "category", "aspect", "sentiment")]
)


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All lines of all files as one relation (bag union, duplicates kept).

    ``line_no`` orders the lines of the input: by file path, then by
    position in the file, which is what "the last line wins" refers to. The
    position comes from the split and the row within it (the splits of one
    file are read in offset order), so a re-run task gives the same values.
    """
    return spark.read.text(_paths(paths)).select(
        F.col("value"),
        F.struct(
            F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos")
        ).alias("line_no"),
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with ``position``: the place of each line (from 1) in the
    order of ``line_no``, the files in name order. A file's lines are numbered
    by themselves and moved on by the lines of the files before it, so only
    one row per file is ever ordered as a whole."""
    placed = lines.withColumn("_file", F.col("line_no.file"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_lines")).select(
        "_file", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_offset")
    )
    within = F.row_number().over(Window.partitionBy("_file").orderBy("line_no.pos"))
    return placed.withColumn("_within", within).join(offsets, "_file").select(
        *lines.columns, (F.col("_within") + F.col("_offset")).alias("position")
    )


def split_lines(lines: DataFrame, min_fields: int, sep: str = ",") -> DataFrame:
    """``lines`` with a ``fields`` array (trailing empty fields dropped);
    lines with fewer than ``min_fields`` fields are dropped."""
    split = lines.withColumn("fields", split_fields(F.col("value"), sep))
    return split.where(F.size("fields") >= min_fields)


def _field(i: int) -> Column:
    return java_trim(F.get("fields", i))


def parse_movies(lines: DataFrame) -> DataFrame:
    """``id, title, genres`` lines -> (movie_id, title, genres).

    A line needs at least one comma. The title is everything between the
    first comma and the last field (so a title may contain commas); with only
    two fields the title is the second one and ``genres`` is NULL. Trailing
    commas are ignored when fields are counted.
    """
    n = F.size("fields")
    between = F.regexp_extract(strip_trailing(F.col("value"), ","), r"^[^,]*,(.*),[^,]*\z", 1)
    title = (
        F.when(n >= 3, java_trim(between))
        .when(n == 2, _field(1))
        .otherwise(F.lit(""))
    )
    genres = F.when(n >= 3, java_trim(F.element_at("fields", -1)))
    # The comma decides, also one that only ends the line.
    return split_lines(lines.where(F.instr("value", ",") > 0), 0).select(
        _field(0).alias("movie_id"), title.alias("title"), genres.alias("genres")
    )


def parse_ratings(lines: DataFrame, rejected: Observation | None = None) -> DataFrame:
    """``user, movie, rating, ts`` lines -> typed ratings; < 3 fields dropped.

    An unparsable rating is kept as NULL so that it counts nowhere. With
    ``rejected``, the scan also counts, in the same pass, its ``lines``, the
    ``short`` ones that are dropped and the kept ones with an ``unparsable``
    rating; the counts are there once an action has run.
    """
    typed = [
        _field(0).alias("user_id"),
        _field(1).alias("movie_id"),
        safe_double(_field(2)).alias("rating"),
        _field(3).try_cast("long").alias("ts"),
    ]
    if rejected is None:
        return split_lines(lines, 3).select(*typed)
    enough = F.size("fields") >= 3
    every = split_lines(lines, 0).select(*typed, enough.alias("_enough"))
    counted = every.observe(
        rejected,
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(~F.col("_enough"), 1)).alias("short"),
        F.count(F.when(F.col("_enough") & F.col("rating").isNull(), 1)).alias("unparsable"),
    )
    return counted.where("_enough").drop("_enough")


def parse_users(lines: DataFrame) -> DataFrame:
    """``user, gender, age, occupation, zip`` lines; < 2 fields dropped.

    ``age`` is NULL when missing or not an integer; ``line_no`` is kept for
    last-line-wins de-duplication.
    """
    return split_lines(lines, 2).select(
        _field(0).alias("user_id"),
        _field(1).alias("gender"),
        safe_int(_field(2)).alias("age"),
        _field(3).alias("occupation"),
        _field(4).alias("zip"),
        F.col("line_no"),
    )


def read_movies(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return parse_movies(read_lines(spark, paths))


def read_ratings(spark: SparkSession, paths: str | Sequence[str], rejected: Observation | None = None) -> DataFrame:
    """One or more rating files read as one relation (duplicates kept);
    ``rejected`` counts bad lines as ``parse_ratings`` says."""
    return parse_ratings(read_lines(spark, paths), rejected)


def read_users(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return parse_users(read_lines(spark, paths))


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str,
    sep: str = ";",
    min_fields: int = 0,
) -> DataFrame:
    """Headerless delimited load with a declared schema and no quoting.

    Empty field -> NULL, short row -> padded with NULL, extra fields -> cut,
    a stray double quote stays part of the text. Rows with fewer than
    ``min_fields`` fields (trailing empty ones not counted) are dropped.
    """
    if min_fields:
        kept = split_lines(spark.read.text(_paths(paths)), min_fields, sep)
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        field = lambda i: F.get("fields", i)
        return kept.select(
            *[F.when(field(i) != "", field(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(wanted.fields)]
        )
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", "false")
        .option("quote", "\u0000")
        .option("escape", "\u0000")
        .option("mode", "PERMISSIVE")
        .csv(_paths(paths))
    )


def read_stopwords(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One stop word (or phrase) per line -> (stopword). The first
    tab-separated field of a line is the entry; an empty line is NULL."""
    return read_delimited(spark, paths, "stopword string", sep="\t")
