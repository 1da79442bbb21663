"""Role frames over the parquet test tables.

The test tables hold no movies or reviews, so tables play those roles:

- ratings: ``lineitem`` (user = l_orderkey, movie = l_partkey,
  rating = l_quantity)
- movies: ``part`` (title = p_name, tags = the words of p_name)
- known movies: ``part`` with ``p_size <= 40``, for the queries about rated
  movies that the movie table does not have
- users: ``orders`` -> ``customer`` (user = o_orderkey; gender-like segment
  from c_mktsegment, age-like number c_acctbal)
- reviews: ``documents`` (id = doc_id, review = text, category = lang,
  aspect = source) with sentiment from ``labels`` (quality 1 positive,
  0 negative, no label = none)

Each frame selects only the columns it needs, so the parquet scans are
pruned, and filters written here reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.functions.values import bucketize, in_synonyms
from sparktally.operators.joins import one_per_key, splittable_join
from sparktally.sources.tables import load_table

# Fixed values of the test roles (shared with the SQL oracles).
MOVIE_MAX_SIZE = 40
TOP_RATED_MIN_SUPPORT = 30
MALE_SEGMENTS = ("AUTOMOBILE", "MACHINERY")
FEMALE_SEGMENTS = ("BUILDING", "FURNITURE")
GENDER_LABELS = ("male", "female")
BALANCE_EDGES = (0.0, 3000.0, 6000.0)
BALANCE_LABELS = ("upto_0", "upto_3000", "upto_6000", "above_6000")
FREQUENT_MIN_EXCLUSIVE = 500
TOP_WORDS_K = 5
# Our stop-word list for the test documents: function words of the four
# languages, plus a phrase (can never equal a token) and a repeated entry.
STOPWORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for",
    "der", "die", "und", "den", "von", "zu", "das",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "une",
    "que", "el", "y", "los", "se", "del", "las",
    "of the", "the",
)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        F.col("l_quantity").alias("rating"),
    )


def movies(spark: SparkSession, sf_dir: str, known_only: bool = False) -> DataFrame:
    part = load_table(spark, sf_dir, "part")
    if known_only:
        part = part.where(F.col("p_size") <= MOVIE_MAX_SIZE)
    return part.select(
        F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title"), F.col("p_name").alias("genres")
    )


def _order_customers(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = load_table(spark, sf_dir, "customer").select("c_custkey", *cols)
    return orders.join(customers, orders.o_custkey == customers.c_custkey, "inner")


def gender_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, segment): 'male' / 'female' by synonym set, else NULL."""
    seg = F.col("c_mktsegment")
    return _order_customers(spark, sf_dir, "c_mktsegment").select(
        F.col("o_orderkey").alias("user_id"),
        F.when(in_synonyms(seg, MALE_SEGMENTS), F.lit("male"))
        .when(in_synonyms(seg, FEMALE_SEGMENTS), F.lit("female"))
        .alias("segment"),
    )


def balance_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, segment): right-closed balance band; NULL balance -> none."""
    return _order_customers(spark, sf_dir, "c_acctbal").select(
        F.col("o_orderkey").alias("user_id"),
        bucketize(F.col("c_acctbal"), BALANCE_EDGES, BALANCE_LABELS).alias("segment"),
    )


def sentiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, sentiment) for labelled documents, one row per document."""
    labels = one_per_key(load_table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", ["quality"])
    q = F.col("quality")
    return labels.select(
        F.col("doc_id").alias("id"),
        F.when(q == 1, F.lit("positive")).when(q == 0, F.lit("negative")).alias("sentiment"),
    )


def reviews(spark: SparkSession, sf_dir: str, with_sentiment: bool = True) -> DataFrame:
    """(id, review, category, aspect[, sentiment]); sentiment NULL for
    unlabelled documents. The label join is at document level, before any
    words are exploded."""
    docs = load_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("review"),
        F.col("lang").alias("category"),
        F.col("source").alias("aspect"),
    )
    if not with_sentiment:
        return docs
    return splittable_join(docs, sentiments(spark, sf_dir), "id", "left")


def stopwords(spark: SparkSession) -> DataFrame:
    """The fixed list as a literal relation, whose size the planner knows."""
    rows = ", ".join("('" + w.replace("'", "\\'") + "')" for w in STOPWORDS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(stopword)")
