"""Report lines for the rating questions: typed results -> ``(key, value)`` text.

Numbers are rendered with two decimals, half up, with a decimal point (the
published outputs carry a decimal comma from the machine's locale; compare
after normalising). Missing averages are rendered only here; typed results
keep NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktally.functions.render import pad_right, two_decimals, two_decimals_or
from sparktally.functions.values import as_col

# Report templates and labels.
MOVIE_VALUE = "AverageRating: %s (TotalRatings: %d)"
BEST_MOVIE_LINE = "%s is the highest rated movie with an average rating of %s among movies with at least %d ratings."
GENRE_VALUE = "Avg: %s, Count: %d"
GENDER_TITLE_WIDTH = 35
GENDER_VALUE = "Male: %s, Female: %s"
GENDER_MISSING = "N/A "
BAND_TITLE_WIDTH = 30
BAND_LABELS = ("0-18", "18-35", "35-50", "50+")
BAND_MISSING = "NA"
BAND_CELL_WIDTH = 4


def render_report(df: DataFrame, key: Column | str, template: str, *cells: Column | str, keep: Sequence[str] = ()) -> DataFrame:
    """(key, value) lines: the key column and ``template`` filled with the
    cells (Java format); ``keep`` columns are carried along."""
    return df.select(as_col(key).alias("key"), F.format_string(template, *map(as_col, cells)).alias("value"), *keep)


def movie_report(rated: DataFrame, label: str = "title", keep: Sequence[str] = ()) -> DataFrame:
    """Q1 lines: ``title`` / ``AverageRating: 4.25 (TotalRatings: 2)``;
    ``keep`` columns are carried along."""
    return render_report(rated, label, MOVIE_VALUE, two_decimals("avg_rating"), "n", keep=keep)


def best_movie_report(best: DataFrame, min_support: int, label: str = "title") -> DataFrame:
    """Q2 line (zero or one): the sentence as key, empty value."""
    sentence = F.format_string(BEST_MOVIE_LINE, F.col(label), two_decimals("avg_rating"), F.lit(min_support))
    return render_report(best, sentence, "")


def genre_report(tags: DataFrame, tag: str = "genre") -> DataFrame:
    """Q3 lines: ``genre`` / ``Avg: 3.73, Count: 20``."""
    return render_report(tags, tag, GENRE_VALUE, two_decimals("avg_rating"), "n")


def gender_report(
    df: DataFrame,
    male: str = "avg_male",
    female: str = "avg_female",
    label: str = "title",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Q4 lines: title padded to 35 / ``Male: 4.50, Female: N/A ``;
    ``keep`` columns are carried along."""
    cells = [two_decimals_or(c, GENDER_MISSING) for c in (male, female)]
    return render_report(df, pad_right(label, GENDER_TITLE_WIDTH), GENDER_VALUE, *cells, keep=keep)


def band_report(
    df: DataFrame,
    cols: Sequence[str],
    labels: Sequence[str] = BAND_LABELS,
    label: str = "title",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Q5 lines: title padded to 30 / ``0-18: NA   18-35: 4.00 ...``, each
    cell padded to 4; ``keep`` columns are carried along."""
    fmt = " ".join(f"{lab}: %-{BAND_CELL_WIDTH}s" for lab in labels)
    cells = [two_decimals_or(c, BAND_MISSING) for c in cols]
    return render_report(df, pad_right(label, BAND_TITLE_WIDTH), fmt, *cells, keep=keep)
