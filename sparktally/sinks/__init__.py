"""Sinks: delimited text and CSV output, previews, report rendering.

Writers always replace the target, so a re-run does not fail on an existing
directory, and do so only once the new files are complete: a write that fails
leaves the old target (``replacing``). Writes are done by the executors, one
file per partition; nothing passes through the driver except ``dump``, which
is bounded by its row limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sparktally.sinks.replace import replacing
from sparktally.sinks.reports import (
    band_report,
    best_movie_report,
    gender_report,
    genre_report,
    movie_report,
    render_report,
)


def write_key_value(df: DataFrame, path: str, key: str, value: str, sep: str = "\t") -> None:
    """One text line per row: ``key<TAB>value``."""
    line = F.concat_ws(sep, F.coalesce(F.col(key), F.lit("")), F.coalesce(F.col(value), F.lit("")))
    with replacing(df.sparkSession, path) as new:
        df.select(line.alias("value")).write.text(new)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Headerless CSV; NULL is written as an empty field, and a field that
    holds the separator is quoted."""
    with replacing(df.sparkSession, path) as new:
        df.write.option("header", "false").option("sep", sep).csv(new)


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """Headerless delimited text with raw fields: no quoting, NULL as an
    empty field. ``read_delimited`` with the same separator reads it back. A
    field that holds the separator would shift the fields after it, so it
    fails the write."""
    held = F.raise_error(F.lit(f"a field holds the separator {sep!r}; store the table as parquet"))
    fields = []
    for c in df.columns:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        fields.append(F.when(F.instr(text, sep) > 0, held).otherwise(text))
    with replacing(df.sparkSession, path) as new:
        df.select(F.concat_ws(sep, *fields).alias("value")).write.text(new)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    with replacing(df.sparkSession, path) as new:
        writer.parquet(new)


def preview(df: DataFrame, n: int = 15) -> DataFrame:
    """The first ``n`` rows, for a quick look (still a DataFrame)."""
    return df.limit(n)


def dump(df: DataFrame, n: int = 10) -> list[Row]:
    """Bring at most ``n`` rows to the client."""
    return df.limit(n).collect()


__all__ = [
    "band_report",
    "best_movie_report",
    "dump",
    "gender_report",
    "genre_report",
    "movie_report",
    "preview",
    "render_report",
    "replacing",
    "write_csv",
    "write_delimited",
    "write_key_value",
    "write_parquet",
]
