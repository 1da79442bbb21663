"""Incremental review ingest: file source -> valid rows -> parquet (append).

The stream keeps only what the count questions need (id and the label
columns) of every valid review that lands in the source folder, and appends
it to a parquet folder with Spark's file sink: exactly once, progress in a
checkpoint, no state and nothing held on the driver. The counts are then the
usual ``count_by`` over that folder, which Spark reads through the sink's
commit log (files of unfinished batches are never read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparktally.operators.counts import count_by
from sparktally.operators.text import valid_reviews
from sparktally.sources.delimited import REVIEW_SCHEMA

KEPT_COLUMNS = ("id", "category", "aspect", "sentiment")


def review_stream(
    spark: SparkSession,
    source_dir: str,
    sep: str = ";",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming (id, category, aspect, sentiment) of the valid reviews of
    every file that lands in ``source_dir`` (same load rules as the batch
    reader; the review text itself is not kept)."""
    reader = (
        spark.readStream.schema(REVIEW_SCHEMA)
        .option("sep", sep)
        .option("header", "false")
        .option("quote", "\u0000")
        .option("escape", "\u0000")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return valid_reviews(reader.csv(source_dir)).select(*KEPT_COLUMNS)


def start_review_ingest(
    spark: SparkSession,
    source_dir: str,
    table_path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Start appending the valid reviews of new files to ``table_path``.

    Progress lives in ``checkpoint``, a shared folder of its own for each
    source and table, so a restarted query reads only the files it has not
    seen. ``available_now`` processes what is there and stops; otherwise the
    query keeps running.
    """
    writer = (
        review_stream(spark, source_dir)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ingested_counts(spark: SparkSession, table_path: str, key: str = "category") -> DataFrame:
    """(key, total_comments) over everything ingested so far."""
    rows = spark.read.parquet(table_path)
    return count_by(rows, [F.lower(key).alias(key)], "id", name="total_comments")
