"""The review questions Q6-Q13 over a ``;``-delimited review file.

``reviews`` has (id, review, category, aspect, sentiment), all strings; the
token table (Q6) has (id, word, category, aspect, sentiment). Counting
follows the rule "count rows whose first field is not NULL" (``id`` for
most questions, ``aspect`` for Q10/Q11), and a group whose count is 0 is
still emitted.

``run_review_reports`` computes the token table once, writes it and reads it
back, so the later questions start from a stored table instead of re-cleaning
the text, and a lost executor costs a re-read, not a re-run of the cleaning.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.operators.counts import count_by, frequent, top_k
from sparktally.operators.text import clean_tokens, valid_reviews
from sparktally.session import delete_path, scratch_path
from sparktally.sinks import replacing, write_csv, write_parquet
from sparktally.sources.delimited import REVIEW_SCHEMA, read_delimited, read_stopwords

# The frequency threshold (strict), the size of the per-group
# top lists and the sentiment labels.
FREQUENT_MIN_EXCLUSIVE = 500
TOP_K = 5
POSITIVE = "positive"
NEGATIVE = "negative"


def review_tokens(reviews: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Q6: cleaned, lower-cased, one row per word, stop words removed."""
    return clean_tokens(reviews, stopwords)


def word_frequencies(tokens: DataFrame, min_exclusive: int = FREQUENT_MIN_EXCLUSIVE) -> DataFrame:
    """Q7: (word, freq) with freq > ``min_exclusive``, most frequent first."""
    return frequent(count_by(tokens, ["word"], "id", name="freq"), "freq", min_exclusive, "word")


def _lowered_counts(reviews: DataFrame, col: str) -> DataFrame:
    valid = valid_reviews(reviews)
    counts = count_by(valid, [F.lower(col).alias(col)], "id", name="total_comments")
    return counts.orderBy(F.desc("total_comments"), F.asc(col))


def category_counts(reviews: DataFrame) -> DataFrame:
    """Q8: (category, total_comments), rows counted, not distinct ids."""
    return _lowered_counts(reviews, "category")


def aspect_counts(reviews: DataFrame) -> DataFrame:
    """Q9: (aspect, total_comments)."""
    return _lowered_counts(reviews, "aspect")


def top_aspect(reviews: DataFrame, sentiment: str) -> DataFrame:
    """Q10 / Q11: (aspect, total) of the aspect with the most reviews of one
    sentiment; ties go to the smallest aspect."""
    valid = valid_reviews(reviews).select(F.lower("aspect").alias("aspect"), F.lower("sentiment").alias("sentiment"))
    counts = count_by(valid, ["aspect"], "aspect", where=F.col("sentiment") == sentiment, name="total")
    return top_k(counts, 1, [F.desc("total"), F.asc("aspect")])


def top_words(tokens: DataFrame, sentiment: str | None = None, k: int = TOP_K, name: str = "total") -> DataFrame:
    """Q12 (one sentiment) / Q13 (all): (category, word, name), the k most
    frequent words per category, ties by word."""
    where = None if sentiment is None else F.col("sentiment") == sentiment
    counts = count_by(tokens, ["category", "word"], "id", where=where, name=name)
    return top_k(counts, k, [F.desc(name), F.asc("word")], per=["category"])


def sliced_word_counts(tokens: DataFrame) -> DataFrame:
    """(category, sentiment, word, n): token counts for every slice at once.

    Q7, Q12 and Q13 are sums of these counts over some of the keys, so one
    aggregation of the token table serves all of them (summing per-slice
    ``count(id)`` gives the ``count(id)`` of the union, zero groups included).
    """
    return count_by(tokens, ["category", "sentiment", "word"], "id", name="n")


def word_frequencies_from(counts: DataFrame, min_exclusive: int = FREQUENT_MIN_EXCLUSIVE) -> DataFrame:
    """Q7 from ``sliced_word_counts``."""
    per_word = counts.groupBy("word").agg(F.sum("n").alias("freq"))
    return frequent(per_word, "freq", min_exclusive, "word")


def top_words_from(
    counts: DataFrame, sentiment: str | None = None, k: int = TOP_K, name: str = "total"
) -> DataFrame:
    """Q12 / Q13 from ``sliced_word_counts``."""
    src = counts if sentiment is None else counts.where(F.col("sentiment") == sentiment)
    per_word = src.groupBy("category", "word").agg(F.sum("n").alias(name))
    return top_k(per_word, k, [F.desc(name), F.asc("word")], per=["category"])


def sliced_review_counts(reviews: DataFrame) -> DataFrame:
    """(category, aspect, sentiment, total_comments, total): valid reviews of
    every slice at once, by ``count(id)`` and by ``count(aspect)``. Q8-Q11 are
    sums of these over some of the keys, groups that count 0 included."""
    keys = [F.lower(c).alias(c) for c in ("category", "aspect", "sentiment")]
    return valid_reviews(reviews).groupBy(*keys).agg(
        F.count("id").alias("total_comments"), F.count(F.col("aspect")).alias("total")
    )


def review_counts_from(counts: DataFrame, col: str) -> DataFrame:
    """Q8 / Q9 from ``sliced_review_counts``."""
    summed = counts.groupBy(col).agg(F.sum("total_comments").alias("total_comments"))
    return summed.orderBy(F.desc("total_comments"), F.asc(col))


def top_aspect_from(counts: DataFrame, sentiment: str) -> DataFrame:
    """Q10 / Q11 from ``sliced_review_counts``."""
    summed = counts.where(F.col("sentiment") == sentiment).groupBy("aspect").agg(F.sum("total").alias("total"))
    return top_k(summed, 1, [F.desc("total"), F.asc("aspect")])


def run_review_reports(
    spark: SparkSession,
    reviews_path: str,
    stopwords_path: str,
    out_dir: str,
    sep: str = ";",
) -> dict[str, str]:
    """Compute Q6-Q13 from the files and write each result under ``out_dir``
    (replacing it): the token table as parquet, the others as headerless CSV.
    Returns name -> output path.

    The review file is read twice: for the token table, and for one
    aggregation that answers Q8-Q11. One aggregation of the token table
    answers Q7, Q12 and Q13. Everything is written beside ``out_dir`` first
    and moved there at the end, so ``out_dir`` is complete or not there; the
    two count tables are removed.
    """
    reviews = read_delimited(spark, reviews_path, REVIEW_SCHEMA, sep=sep)
    stop = read_stopwords(spark, stopwords_path)
    run = uuid.uuid4().hex
    scratch = [scratch_path(spark, f"{name}-{run}") for name in ("review-counts", "word-counts")]

    def stored(df: DataFrame, path: str) -> DataFrame:
        write_parquet(df, path)
        return spark.read.parquet(path)

    try:
        with replacing(spark, out_dir) as staging:
            tokens = stored(review_tokens(reviews, stop), os.path.join(staging, "tokens"))
            slices = stored(sliced_review_counts(reviews), scratch[0])
            words = stored(sliced_word_counts(tokens), scratch[1])
            results = {
                "word_freq": word_frequencies_from(words),
                "category_count": review_counts_from(slices, "category"),
                "aspect_count": review_counts_from(slices, "aspect"),
                "top_aspect_positive": top_aspect_from(slices, POSITIVE),
                "top_aspect_negative": top_aspect_from(slices, NEGATIVE),
                "top5_positive": top_words_from(words, POSITIVE, name="total"),
                "top5_negative": top_words_from(words, NEGATIVE, name="total"),
                "top5_all": top_words_from(words, None, name="total_freq"),
            }
            for name, df in results.items():
                write_csv(df, os.path.join(staging, name))
    finally:
        for path in scratch:
            delete_path(spark, path)
    return {name: os.path.join(out_dir, name) for name in ("tokens", *results)}


__all__ = [
    "aspect_counts",
    "category_counts",
    "review_counts_from",
    "review_tokens",
    "run_review_reports",
    "sliced_review_counts",
    "sliced_word_counts",
    "top_aspect",
    "top_aspect_from",
    "top_words",
    "top_words_from",
    "word_frequencies",
    "word_frequencies_from",
]
