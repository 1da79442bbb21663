"""Sources: delimited text inputs and the parquet tables of a data directory."""

from sparktally.sources.delimited import (
    MOVIES_SCHEMA,
    RATINGS_SCHEMA,
    REVIEW_SCHEMA,
    TOKENS_SCHEMA,
    USERS_SCHEMA,
    number_lines,
    parse_movies,
    parse_ratings,
    parse_users,
    read_delimited,
    read_lines,
    read_movies,
    read_ratings,
    read_stopwords,
    read_users,
    split_lines,
)
from sparktally.sources.tables import TABLES, load_table, table_path

__all__ = [
    "MOVIES_SCHEMA",
    "RATINGS_SCHEMA",
    "REVIEW_SCHEMA",
    "TABLES",
    "TOKENS_SCHEMA",
    "USERS_SCHEMA",
    "load_table",
    "number_lines",
    "parse_movies",
    "parse_ratings",
    "parse_users",
    "read_delimited",
    "read_lines",
    "read_movies",
    "read_ratings",
    "read_stopwords",
    "read_users",
    "split_lines",
    "table_path",
]
