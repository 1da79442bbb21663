"""Queries through files: derived rows are written by the executors to the
scratch folder, read back by the readers, and answered from what was read.

``FILE_SQL`` states the answers on the tables themselves, so a row that a
writer or reader loses, shifts or reorders shows. The written folders are
deleted when the driver ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparktally.functions.values import in_synonyms
from sparktally.operators import clean_tokens, count_by, last_per_key, rate_entities, remove_stopwords, top_k
from sparktally.plans import roles
from sparktally.plans.edges import _RATING_LINES, RATING_LINE
from sparktally.plans.oracle import _TOKENS, _top_words_sql
from sparktally.session import delete_at_exit, scratch_path
from sparktally.sinks import dump, preview, write_csv, write_delimited, write_key_value, write_parquet
from sparktally.sources import (
    REVIEW_SCHEMA,
    TOKENS_SCHEMA,
    number_lines,
    parse_ratings,
    read_delimited,
    read_lines,
    read_ratings,
    read_stopwords,
    read_users,
)
from sparktally.sources.tables import load_table


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"files-{name}-{uuid.uuid4().hex}")


def _written_lines(df: DataFrame, line: str, name: str) -> str:
    """The lines written as text files; spread over files by content, as many
    as their size asks for (a line repeated very often is split as well)."""
    path = _folder(df.sparkSession, name)
    df.select(F.expr(line).alias("value")).hint("rebalance", "value").write.text(path)
    delete_at_exit(df.sparkSession, path)
    return path


# Fixed texts of both engines: rows of five fields separated by semicolons.
# Short, empty, extra and trailing fields, stray and paired quotes.
REVIEW_LINE = """CASE p_partkey % 8
  WHEN 0 THEN concat(p_partkey, ';', p_name)
  WHEN 1 THEN concat(p_partkey, ';', p_name, ';', p_brand, ';', p_type, ';', p_size, ';extra;more')
  WHEN 2 THEN concat(p_partkey, ';"', p_name, ';', p_brand, ';', p_type, '";', p_size)
  WHEN 3 THEN concat(p_partkey, ';"', p_name, '";', p_brand, ';"";', p_size)
  WHEN 4 THEN concat(p_partkey, ';;', p_brand, ';;', p_size)
  WHEN 5 THEN concat(p_partkey)
  WHEN 6 THEN concat(';', p_name, ';;;')
  ELSE concat(p_partkey, '; ', p_name, ' ;', p_brand, '\\\\;', p_type, ';', p_size) END"""
REVIEW_LINE_SQL = REVIEW_LINE.replace("\\\\", "\\")

USER_FIRST = "concat('u', c_custkey, ', ', CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'female' ELSE 'X' END, ', ', c_custkey % 70)"
USER_SECOND = "concat('u', c_custkey, ', ', CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE '1' END, ', 33')"
SHARED_LINE = "concat('u', l_orderkey, ', ', l_partkey, ', ', l_quantity, ', ', l_linenumber)"


def q_delimited_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines read with a declared schema: short rows padded, extra fields
    cut, empty fields NULL, quotes ordinary characters."""
    path = _written_lines(load_table(spark, sf_dir, "part"), REVIEW_LINE, "reviews")
    return read_delimited(spark, path, REVIEW_SCHEMA)


def q_delimited_min_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines, rows of fewer than three fields dropped."""
    path = _written_lines(load_table(spark, sf_dir, "part"), REVIEW_LINE, "reviews")
    return read_delimited(spark, path, REVIEW_SCHEMA, min_fields=3)


def q_stored_token_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token table stored as delimited text and loaded again: the most
    frequent words per category, counted from what was loaded."""
    tokens = clean_tokens(roles.reviews(spark, sf_dir), roles.stopwords(spark))
    path = _folder(spark, "tokens")
    write_delimited(tokens, path, sep=",")
    delete_at_exit(spark, path)
    loaded = read_delimited(spark, path, TOKENS_SCHEMA, sep=",")
    counts = count_by(loaded, ["category", "word"], "id", name="total_freq")
    return top_k(counts, roles.TOP_WORDS_K, [F.desc("total_freq"), F.asc("word")], per=["category"])


def q_csv_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that hold the separator, quotes or nothing, written as CSV and
    read by Spark's own CSV reader."""
    part = load_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.expr("CASE p_partkey % 3 WHEN 0 THEN concat(p_name, ', ', p_brand) WHEN 1 THEN NULL ELSE p_name END").alias("name"),
        "p_type",
    )
    path = _folder(spark, "csv")
    write_csv(part, path)
    delete_at_exit(spark, path)
    return spark.read.schema("id string, name string, p_type string").csv(path)


def q_several_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rating inputs read as one: every tenth line is in both and counts
    twice."""
    items = load_table(spark, sf_dir, "lineitem")
    first = _written_lines(items.where("l_orderkey % 2 = 0 OR l_orderkey % 10 = 1"), SHARED_LINE, "ratings-1")
    second = _written_lines(items.where("l_orderkey % 2 = 1"), SHARED_LINE, "ratings-2")
    movies = roles.movies(spark, sf_dir).withColumn("movie_id", F.col("movie_id").cast("string"))
    return rate_entities(read_ratings(spark, [first, second]), movies)


def q_last_line_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of two inputs, the last line winning: by file name, then by
    place in the file. The second input names every other user again."""
    cust = load_table(spark, sf_dir, "customer")
    base = _folder(spark, "users")
    # One file each, so that both lines of a user in the first are in order.
    twice = cust.withColumn("again", F.explode(F.array(F.lit(0), F.lit(1))))
    line = f"CASE WHEN again = 1 THEN {USER_FIRST} ELSE concat('u', c_custkey, ', other, 5') END"
    ordered = twice.repartitionByRange(3, "c_custkey").sortWithinPartitions("c_custkey", "again")
    ordered.select(F.expr(line).alias("value")).write.text(f"{base}/1")
    cust.where("c_custkey % 2 = 0").select(F.expr(USER_SECOND).alias("value")).write.text(f"{base}/2")
    delete_at_exit(spark, base)
    users = last_per_key(read_users(spark, [f"{base}/2", f"{base}/1"]), "user_id", ["gender", "age"])
    g = F.col("gender")
    seg = F.when(in_synonyms(g, ("M", "Male"), ("1",)), "male").when(in_synonyms(g, ("F", "Female"), ("0",)), "female")
    return users.select("user_id", seg.alias("segment"), "age")


def q_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rating lines were read, dropped for too few fields, and kept
    without a usable rating: counted by the one scan that stores the parsed
    ratings."""
    path = _written_lines(load_table(spark, sf_dir, "lineitem"), RATING_LINE, "ratings")
    counts = Observation()
    parsed = parse_ratings(read_lines(spark, path), counts)
    stored = _folder(spark, "parsed")
    write_parquet(parsed, stored)
    delete_at_exit(spark, stored)
    found = counts.get
    kept = spark.read.parquet(stored).agg(F.count(F.lit(1)).alias("kept"))
    return kept.select(*[F.lit(found[c]).cast("long").alias(c) for c in ("lines", "short", "unparsable")], "kept")


def q_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted by a column that is NULL in some: the NULL key is a group,
    and a group of only NULLs is there with 0."""
    docs = load_table(spark, sf_dir, "documents").select(
        F.expr("CASE doc_id % 5 WHEN 0 THEN NULL ELSE concat(lang, doc_id % 5) END").alias("category"),
        F.expr("CASE WHEN doc_id % 5 = 2 OR doc_id % 3 = 0 THEN NULL ELSE doc_id END").alias("id"),
    )
    return count_by(docs, ["category"], "id", name="total_comments")


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_tokens(roles.reviews(spark, sf_dir, with_sentiment=False).select("id", "review", "category"), lower_cols=("category",))


def q_long_stop_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens not on a stop list that grows with the corpus (every word of an
    odd number of letters, from a file of one entry a line): counts per
    category. Equal tokens are counted before they meet the list, so that what
    is shuffled and sorted grows with the words there are, not with the text."""
    tokens = _words(spark, sf_dir)
    entries = tokens.where("length(word) % 2 = 1").select("word").distinct()
    path = _folder(spark, "stop-words")
    entries.select(F.col("word").alias("value")).write.text(path)
    delete_at_exit(spark, path)
    # Stored, as Spark would move the anti-join below an aggregate.
    stored = _folder(spark, "token-counts")
    write_parquet(count_by(tokens, ["category", "word"], "id"), stored)
    delete_at_exit(spark, stored)
    kept = remove_stopwords(spark.read.parquet(stored), read_stopwords(spark, path), long_list=True)
    return kept.groupBy("category").agg(F.sum("n").alias("total"))


def q_ordered_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word counts written as ``word<TAB>count`` lines, most frequent
    first, and read back: each line with its place over all files."""
    counts = count_by(_words(spark, sf_dir), ["word"], "id", name="n").orderBy(F.desc("n"), F.asc("word"))
    path = _folder(spark, "ordered")
    write_key_value(counts, path, "word", "n")
    delete_at_exit(spark, path)
    lines = number_lines(read_lines(spark, path))
    parts = F.split("value", "\t")
    return lines.select("position", parts[0].alias("word"), parts[1].cast("long").alias("n"))


def q_replaced_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder written twice: the parts of one kind, then a replacement made
    from the rows of the folder itself."""
    part = load_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    path = _folder(spark, "replaced")
    write_delimited(part.where("p_partkey % 2 = 0"), path)
    delete_at_exit(spark, path)
    old = read_delimited(spark, path, "p_partkey long, p_name string", sep=",")
    write_delimited(old.withColumn("p_name", F.upper("p_name")), path)
    return read_delimited(spark, path, "p_partkey long, p_name string", sep=",")


def q_preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first fifteen words of the ordered counts, and how many rows a
    dump of ten brings to the client."""
    counts = count_by(_words(spark, sf_dir), ["word"], "id", name="n").orderBy(F.desc("n"), F.asc("word"))
    first = preview(counts)
    return first.withColumn("dumped", F.lit(len(dump(first))))


FILE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "delimited_fields": q_delimited_fields,
    "delimited_min_fields": q_delimited_min_fields,
    "stored_token_words": q_stored_token_words,
    "csv_fields": q_csv_fields,
    "several_files": q_several_files,
    "last_line_of_files": q_last_line_of_files,
    "rejected_lines": q_rejected_lines,
    "null_counts": q_null_counts,
    "long_stop_list": q_long_stop_list,
    "ordered_output": q_ordered_output,
    "replaced_target": q_replaced_target,
    "preview_rows": q_preview_rows,
}

_FIELDS = ", ".join(f"nullif(f[{i}], '') AS {n}" for i, n in enumerate(("id", "review", "category", "aspect", "sentiment"), 1))
_SPLIT = f"SELECT string_split({REVIEW_LINE_SQL}, ';') AS f FROM part"
_ALL_WORDS = f"""{_TOKENS.strip()},
word_counts AS (SELECT word, count(id) AS n FROM all_tokens GROUP BY word)"""

FILE_SQL: dict[str, str] = {
    "delimited_fields": f"SELECT {_FIELDS} FROM ({_SPLIT})",
    "delimited_min_fields": f"""
SELECT {_FIELDS} FROM (SELECT string_split(rtrim({REVIEW_LINE_SQL}, ';'), ';') AS f FROM part) WHERE len(f) >= 3
""",
    "stored_token_words": _top_words_sql(None, "total_freq"),
    "csv_fields": """
SELECT CAST(p_partkey AS VARCHAR) AS id,
       CASE p_partkey % 3 WHEN 0 THEN concat(p_name, ', ', p_brand) WHEN 1 THEN NULL ELSE p_name END AS name, p_type
FROM part
""",
    "several_files": """
WITH r AS (
  SELECT l_partkey AS movie_id, l_quantity AS rating FROM lineitem
  UNION ALL SELECT l_partkey, l_quantity FROM lineitem WHERE l_orderkey % 10 = 1
), d AS (SELECT p_partkey AS movie_id, max(p_name) AS title FROM part GROUP BY p_partkey)
SELECT CAST(r.movie_id AS VARCHAR) AS movie_id, coalesce(max(title), 'Unknown Movie') AS title,
       avg(rating) AS avg_rating, count(rating) AS n
FROM r LEFT JOIN d USING (movie_id) GROUP BY r.movie_id
""",
    "last_line_of_files": """
SELECT concat('u', c_custkey) AS user_id,
       CASE WHEN c_custkey % 2 = 0 THEN 'female' WHEN c_custkey % 3 = 0 THEN 'male' WHEN c_custkey % 3 = 1 THEN 'female' END AS segment,
       CAST(CASE WHEN c_custkey % 2 = 0 THEN 33 ELSE c_custkey % 70 END AS INTEGER) AS age
FROM customer
""",
    "rejected_lines": f"""
WITH {_RATING_LINES.strip()}
SELECT (SELECT count(*) FROM rl) AS lines, (SELECT count(*) FROM rl WHERE len(f) < 3) AS short,
       (SELECT count(*) FROM rk WHERE rating IS NULL AND word IS NULL) AS unparsable, (SELECT count(*) FROM rp) AS kept
""",
    "null_counts": """
SELECT CASE doc_id % 5 WHEN 0 THEN NULL ELSE concat(lang, doc_id % 5) END AS category,
       count(CASE WHEN doc_id % 5 = 2 OR doc_id % 3 = 0 THEN NULL ELSE doc_id END) AS total_comments
FROM documents GROUP BY 1
""",
    "long_stop_list": f"""
WITH {_TOKENS.strip()}
SELECT category, count(id) AS total FROM all_tokens WHERE length(word) % 2 = 0 GROUP BY category
""",
    "ordered_output": f"""
WITH {_ALL_WORDS}
SELECT row_number() OVER (ORDER BY n DESC, word) AS position, word, n FROM word_counts
""",
    "replaced_target": "SELECT p_partkey, upper(p_name) AS p_name FROM part WHERE p_partkey % 2 = 0",
    "preview_rows": f"""
WITH {_ALL_WORDS}
SELECT word, n, 10 AS dumped FROM word_counts ORDER BY n DESC, word LIMIT 15
""",
}
