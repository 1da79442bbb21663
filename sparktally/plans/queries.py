"""Named queries over a scale-factor directory: ``name -> (spark, sf_dir) -> DataFrame``.

Questions Q1-Q13 map to the operators; the remaining entries exercise single
operators of the inventory on their own. Every query reads whole tables;
``rate_entities``, ``movie_report``, ``left_join_default`` and ``anti_join``
take the known movies only as their movie table, to have movies without one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.functions.exact import LIMBS, exact_avg, exact_avg_where, limbs
from sparktally.functions.text import clean_text, java_trim, text_words
from sparktally.functions.values import bucketize, safe_int
from sparktally.operators import (
    UNKNOWN_TITLE,
    anti_join,
    clean_tokens,
    count_by,
    frequent,
    group_collect,
    left_join_default,
    one_per_key,
    rate_by_segment,
    rate_entities,
    rate_tags,
    rating_stats,
    tag_parts,
    top_k,
    top_rated,
    union_all,
    valid_reviews,
)
from sparktally.plans import roles
from sparktally.sinks.reports import band_report, best_movie_report, gender_report, genre_report, movie_report
from sparktally.sources.tables import load_table

Query = Callable[[SparkSession, str], DataFrame]

# Ship date that splits lineitem into the two rating inputs of union_inputs
# (both halves non-empty at every scale factor; timestamps without zone).
UNION_SPLIT_DATE = "1998-01-01"


# -- ratings -----------------------------------------------------------------


def q_rate_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: average rating and count per movie."""
    return rate_entities(roles.ratings(spark, sf_dir), roles.movies(spark, sf_dir, known_only=True))


def q_top_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: best-rated movie among those with enough ratings."""
    stats = rating_stats(roles.ratings(spark, sf_dir))
    return top_rated(stats, roles.TOP_RATED_MIN_SUPPORT, movies=roles.movies(spark, sf_dir))


def q_rate_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: rating-weighted average and count per tag (words of the name)."""
    return rate_tags(roles.ratings(spark, sf_dir), roles.movies(spark, sf_dir), sep=" ")


def q_rate_by_segment_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: per movie, average of two synonym-defined user segments."""
    return rate_by_segment(
        roles.ratings(spark, sf_dir),
        roles.gender_segments(spark, sf_dir),
        roles.GENDER_LABELS,
        roles.movies(spark, sf_dir),
    )


def q_rate_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: per movie, average of each right-closed balance band."""
    return rate_by_segment(
        roles.ratings(spark, sf_dir),
        roles.balance_segments(spark, sf_dir),
        roles.BALANCE_LABELS,
        roles.movies(spark, sf_dir),
    )


# -- review text ---------------------------------------------------------------


def _tokens(spark: SparkSession, sf_dir: str, stop: bool = True, with_sentiment: bool = True) -> DataFrame:
    reviews = roles.reviews(spark, sf_dir, with_sentiment)
    return clean_tokens(reviews, roles.stopwords(spark) if stop else None)


def q_clean_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 (first half): cleaned, lower-cased, tokenised reviews."""
    return _tokens(spark, sf_dir, stop=False)


def q_remove_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: the token table, stop words removed."""
    return _tokens(spark, sf_dir)


def _word_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _tokens(spark, sf_dir, with_sentiment=False)
    return frequent(count_by(tokens, ["word"], "id", name="freq"), "freq", roles.FREQUENT_MIN_EXCLUSIVE, "word")


def q_frequent_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: words occurring more than 500 times, most frequent first."""
    return _word_freq(spark, sf_dir)


def q_ordered_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 10 rows of Q7's ordered result."""
    return _word_freq(spark, sf_dir).limit(10)


def _count_reviews(spark: SparkSession, sf_dir: str, col: str) -> DataFrame:
    docs = valid_reviews(roles.reviews(spark, sf_dir, with_sentiment=False))
    counts = count_by(docs, [F.lower(col).alias(col)], "id", name="total_comments")
    return counts.orderBy(F.desc("total_comments"), F.asc(col))


def q_count_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8: review count per lower-cased category."""
    return _count_reviews(spark, sf_dir, "category")


def q_count_by_aspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9: review count per lower-cased aspect."""
    return _count_reviews(spark, sf_dir, "aspect")


def _top_aspect(spark: SparkSession, sf_dir: str, sentiment: str) -> DataFrame:
    docs = valid_reviews(roles.reviews(spark, sf_dir)).select(
        F.lower("aspect").alias("aspect"), F.lower("sentiment").alias("sentiment")
    )
    counts = count_by(docs, ["aspect"], "aspect", where=F.col("sentiment") == sentiment, name="total")
    return top_k(counts, 1, [F.desc("total"), F.asc("aspect")])


def q_top_source_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10: aspect with the most positive reviews."""
    return _top_aspect(spark, sf_dir, "positive")


def q_top_source_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11: aspect with the most negative reviews."""
    return _top_aspect(spark, sf_dir, "negative")


def _top_words(
    spark: SparkSession, sf_dir: str, sentiment: str | None, name: str, ordered: bool = True
) -> DataFrame:
    tokens = _tokens(spark, sf_dir, with_sentiment=sentiment is not None)
    where = None if sentiment is None else F.col("sentiment") == sentiment
    counts = count_by(tokens, ["category", "word"], "id", where=where, name=name)
    return top_k(counts, roles.TOP_WORDS_K, [F.desc(name), F.asc("word")], per=["category"], ordered=ordered)


def q_top5_words_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12 (positive): five most frequent words per category."""
    return _top_words(spark, sf_dir, "positive", "total")


def q_top5_words_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12 (negative): five most frequent words per category."""
    return _top_words(spark, sf_dir, "negative", "total")


def q_top5_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13: five most frequent words per category, all sentiments."""
    return _top_words(spark, sf_dir, None, "total_freq")


# -- single operators ----------------------------------------------------------


def q_union_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bag union of two rating inputs (lineitem split by ship date), rated
    per movie: the union keeps every row of both."""
    items = load_table(spark, sf_dir, "lineitem")
    early = F.col("l_shipdate") < F.lit(UNION_SPLIT_DATE).cast("timestamp_ntz")
    part_a = items.where(early)
    part_b = items.where(~early | F.col("l_shipdate").isNull())
    cols = [F.col("l_partkey").alias("movie_id"), F.col("l_quantity").alias("rating")]
    both = union_all(part_a.select(*cols), part_b.select(*cols))
    return both.groupBy("movie_id").agg(exact_avg("rating").alias("avg_rating"), F.count("rating").alias("n"))


def q_filter_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with a non-NULL, non-empty text, with the length of the
    cleaned text (0 when nothing survives cleaning). The validity test is on
    the raw text, as the jobs do it."""
    docs = valid_reviews(roles.reviews(spark, sf_dir, with_sentiment=False))
    return docs.select("id", F.length(clean_text(F.col("review"))).alias("clean_chars"))


def q_left_join_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rating row with its movie title, a default where unknown."""
    items = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("movie_id")
    )
    known = roles.movies(spark, sf_dir, known_only=True).select("movie_id", "title")
    dim = one_per_key(known, "movie_id", ["title"])
    return left_join_default(items, dim, "movie_id", {"title": UNKNOWN_TITLE}, hot_keys=True)


def q_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating rows whose movie is missing from the movie table."""
    items = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return anti_join(items, roles.movies(spark, sf_dir, known_only=True), "l_partkey", "movie_id")


def q_safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse the number after '#' in the brand, and the name as a number
    (never one): failures are NULL, not errors."""
    part = load_table(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        safe_int(F.regexp_extract("p_brand", r"#([^#]*)$", 1)).alias("brand_no"),
        safe_int(F.col("p_name")).alias("name_no"),
    )


def q_explode_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per word of the part name (a space-separated list)."""
    part = load_table(spark, sf_dir, "part")
    tags = part.select("p_partkey", F.explode(tag_parts(F.col("p_name"), " ")).alias("tag"))
    return tags.select("p_partkey", java_trim("tag").alias("tag"))


def q_bucketize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right-closed balance band of every customer."""
    cust = load_table(spark, sf_dir, "customer")
    return cust.select(
        "c_custkey", bucketize(F.col("c_acctbal"), roles.BALANCE_EDGES, roles.BALANCE_LABELS).alias("band")
    )


def q_conditional_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part, average quantity for each return flag, side by side."""
    items = load_table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    cut = items.select(F.col("l_partkey").alias("movie_id"), "l_returnflag", "l_quantity", *limbs("l_quantity"))
    return cut.groupBy("movie_id").agg(
        *[exact_avg_where(LIMBS, "l_quantity", flag == f).alias(f"avg_{f.lower()}") for f in ("A", "N", "R")]
    )


def q_group_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13's top words kept together per category as one ordered list,
    rendered ``word:count`` joined by commas."""
    top = _top_words(spark, sf_dir, None, "total_freq", ordered=False)
    ranked = top.select("category", "word", "total_freq", (-F.col("total_freq")).alias("neg"))
    bags = group_collect(ranked, ["category"], ["neg", "word", "total_freq"], name="items")
    text = F.transform("items", lambda s: F.concat_ws(":", s["word"], s["total_freq"].cast("string")))
    return bags.select("category", F.array_join(text, ",").alias("words"))


def q_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words per review after cleaning (tokeniser without the explode)."""
    docs = valid_reviews(roles.reviews(spark, sf_dir, with_sentiment=False))
    return docs.select("id", F.size(text_words(F.col("review"))).alias("n_words"))


def q_movie_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 rendered as report lines: title, then
    ``AverageRating: x.xx (TotalRatings: n)`` (two decimals, half up)."""
    lines = movie_report(q_rate_entities(spark, sf_dir), keep=["movie_id"])
    return lines.select(F.col("key").alias("title"), F.col("value").alias("line"), "movie_id")


def q_band_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 rendered: padded title and one padded cell per band (``NA`` when
    the band has no rating)."""
    cols = [f"avg_{lab}" for lab in roles.BALANCE_LABELS]
    lines = band_report(q_rate_by_band(spark, sf_dir), cols, labels=roles.BALANCE_LABELS, keep=["movie_id"])
    return lines.select(F.col("key").alias("title"), F.col("value").alias("line"), "movie_id")


def q_best_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 rendered: the one-sentence line naming the best movie."""
    best = best_movie_report(q_top_rated(spark, sf_dir), roles.TOP_RATED_MIN_SUPPORT)
    return best.select(F.col("key").alias("line"))


def q_genre_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 rendered: tag, then ``Avg: x.xx, Count: n``."""
    lines = genre_report(q_rate_tags(spark, sf_dir))
    return lines.select(F.col("key").alias("genre"), F.col("value").alias("line"))


def q_gender_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 rendered: title padded to 35, then ``Male: x.xx, Female: N/A ``."""
    rated = q_rate_by_segment_two(spark, sf_dir)
    lines = gender_report(rated, keep=["movie_id"])
    return lines.select(F.col("key").alias("title"), F.col("value").alias("line"), "movie_id")


QUERIES: dict[str, Query] = {
    "rate_entities": q_rate_entities,
    "top_rated": q_top_rated,
    "rate_tags": q_rate_tags,
    "rate_by_segment_two": q_rate_by_segment_two,
    "rate_by_band": q_rate_by_band,
    "clean_tokens": q_clean_tokens,
    "remove_stopwords": q_remove_stopwords,
    "frequent_words": q_frequent_words,
    "count_by_category": q_count_by_category,
    "count_by_aspect": q_count_by_aspect,
    "top_source_positive": q_top_source_positive,
    "top_source_negative": q_top_source_negative,
    "top5_words_positive": q_top5_words_positive,
    "top5_words_negative": q_top5_words_negative,
    "top5_words": q_top5_words,
    "union_inputs": q_union_inputs,
    "filter_valid": q_filter_valid,
    "left_join_default": q_left_join_default,
    "anti_join": q_anti_join,
    "safe_cast": q_safe_cast,
    "explode_list": q_explode_list,
    "bucketize": q_bucketize,
    "conditional_avg": q_conditional_avg,
    "group_collect": q_group_collect,
    "ordered_limit": q_ordered_limit,
    "word_counts": q_word_counts,
    "movie_report": q_movie_report,
    "band_report": q_band_report,
    "best_report": q_best_report,
    "genre_report": q_genre_report,
    "gender_report": q_gender_report,
}
