"""Queries that reach the rules the plain tables never do.

The test tables are clean, so these queries derive, by key arithmetic over
whole tables, text lines with malformed fields (parsed by the line readers)
and role frames with NULL and empty values, repeated keys, unknown users,
placeholders and values on band edges. ``EDGE_SQL`` says the same in SQL; the
expressions that build the inputs are shared text, the rules are not.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparktally.functions.values import bucketize, in_synonyms, safe_double, safe_int
from sparktally.operators import (
    UNKNOWN_TITLE,
    count_by,
    last_per_key,
    left_join_default,
    one_per_key,
    rate_by_segment,
    rate_entities,
    rate_tags,
    rating_stats,
    top_rated,
    valid_reviews,
)
from sparktally.plans import roles
from sparktally.sources import parse_movies, parse_ratings, parse_users
from sparktally.sources.tables import load_table

# -- inputs: expressions both engines read the same way -----------------------

MOVIE_LINE = """CASE p_partkey % 10
  WHEN 0 THEN concat(p_partkey)
  WHEN 1 THEN concat(p_partkey, ', ', p_name, ', ', p_brand, '|', p_type, ',,')
  WHEN 2 THEN concat(p_partkey, ', ', p_name)
  WHEN 3 THEN concat(p_partkey, ', ', p_name, ', the second, ', p_type)
  WHEN 4 THEN concat(chr(9), p_partkey, chr(11), ',', chr(9), p_name, chr(31), ', ', p_type, chr(9))
  WHEN 5 THEN concat(p_partkey, ', ', p_name, ', ')
  WHEN 6 THEN concat(p_partkey, ',')
  WHEN 7 THEN concat(p_partkey, ', ', p_name, ', ', p_brand, '||', p_type)
  ELSE concat(p_partkey, ', ', p_name, ', ', p_brand, '|', p_type) END"""

RATING_LINE = """CASE (l_orderkey + l_linenumber) % 16
  WHEN 0 THEN concat('u', l_orderkey, ', ', l_partkey)
  WHEN 1 THEN concat('u', l_orderkey, ', ', l_partkey, ', ', l_quantity, ',')
  WHEN 2 THEN concat('u', l_orderkey, ', ', l_partkey, ', abc, 1')
  WHEN 3 THEN concat('u', l_orderkey, ', ', l_partkey, ', nan, 1')
  WHEN 4 THEN concat('u', l_orderkey, ', ', l_partkey, ', inf, 1')
  WHEN 5 THEN concat('u', l_orderkey, ', ', l_partkey, ', INFINITY, 1')
  WHEN 6 THEN concat('u', l_orderkey, ', ', l_partkey, ', -inf, x')
  WHEN 7 THEN concat('u', l_orderkey, ', ', l_partkey, ', NaN, 1')
  WHEN 8 THEN concat('u', l_orderkey, ', ', l_partkey, ', Infinity, 1')
  WHEN 9 THEN concat('u', l_orderkey, ', ', l_partkey, ', -Infinity, 1')
  WHEN 10 THEN concat('u', l_orderkey, ', ', l_partkey, ', 4.0d, 1')
  WHEN 11 THEN concat(chr(9), 'u', l_orderkey, ' ,', l_partkey, chr(11), ',', chr(9), l_quantity, chr(9), ', 7')
  WHEN 12 THEN concat('u', l_orderkey, ', ', l_partkey, ', , 1')
  ELSE concat('u', l_orderkey, ', ', l_partkey, ', ', l_quantity, ', ', l_linenumber) END"""

USER_LINE = """CASE c_custkey % 9
  WHEN 0 THEN concat('u', c_custkey)
  WHEN 1 THEN concat('u', c_custkey, ', M, abc, 1, 2')
  WHEN 2 THEN concat('u', c_custkey, ', male, 25.7')
  WHEN 3 THEN concat('u', c_custkey, ', 1')
  WHEN 4 THEN concat('u', c_custkey, ',', chr(9), 'F', chr(9), ', ', c_custkey % 90, ', 3, 44')
  WHEN 5 THEN concat('u', c_custkey, ', FEMALE, 18,,')
  WHEN 6 THEN concat('u', c_custkey, ', 0, 35, x, y')
  WHEN 7 THEN concat('u', c_custkey, ', X, 50')
  ELSE concat('u', c_custkey, ', f, 51, z, 9') END"""
# A second line for every fifth customer, which wins.
USER_AGAIN = "concat('u', c_custkey, ', ', CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'Female' END, ', ', c_custkey % 60)"

TEXT_EDGE = "CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END"
RATING_EDGE = "CASE WHEN l_orderkey % 7 = 0 OR l_partkey % 17 = 0 THEN NULL ELSE l_quantity END"
GENRES_EDGE = """CASE p_partkey % 11
  WHEN 0 THEN '(no genres listed)'
  WHEN 1 THEN ''
  WHEN 2 THEN concat(replace(p_name, ' ', '|'), '||')
  WHEN 3 THEN concat(' ', replace(p_name, ' ', ' | '), ' ')
  WHEN 4 THEN concat(replace(p_name, ' ', '||'), '|', p_type)
  WHEN 5 THEN '|'
  ELSE replace(p_name, ' ', '|') END"""
SEGMENT_EDGE = "CASE o_orderkey % 4 WHEN 0 THEN lower(c_mktsegment) WHEN 1 THEN 'Building' WHEN 2 THEN NULL ELSE c_mktsegment END"
BALANCE_EDGE = """CASE c_custkey % 6 WHEN 0 THEN 0.0 WHEN 1 THEN 3000.0 WHEN 2 THEN 6000.0 WHEN 3 THEN NULL
  WHEN 4 THEN 6000.01 ELSE c_acctbal END"""


def _lines(df: DataFrame, line: str, number: int = 1) -> DataFrame:
    return df.select(F.expr(line).alias("value"), F.lit(number).alias("line_no"))


def _kind(value: Column) -> Column:
    """What a parsed number is; keeps NaN out of compared values."""
    return (
        F.when(value.isNull(), "none").when(F.isnan(value), "NaN")
        .when(value == float("inf"), "inf").when(value == float("-inf"), "-inf").otherwise("number")
    )


def q_parse_movie_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movie lines: short, two fields, commas in the title, trailing commas,
    tabs and control characters, empty genres."""
    return parse_movies(_lines(load_table(spark, sf_dir, "part"), MOVIE_LINE))


def q_parse_rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating lines: short, trailing comma, unparsable and special numbers."""
    parsed = parse_ratings(_lines(load_table(spark, sf_dir, "lineitem"), RATING_LINE))
    kind = _kind(F.col("rating"))
    return parsed.select(
        "user_id", "movie_id", F.when(kind == "number", F.col("rating")).alias("rating"), kind.alias("kind"), "ts"
    )


def q_parse_user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User lines, the last line of a user winning: gender segment, and age
    band of the last line with an age."""
    cust = load_table(spark, sf_dir, "customer")
    users = parse_users(_lines(cust, USER_LINE).unionByName(_lines(cust.where("c_custkey % 5 = 0"), USER_AGAIN, 2)))
    g = F.col("gender")
    seg = F.when(in_synonyms(g, ("M", "Male"), ("1",)), "male").when(in_synonyms(g, ("F", "Female"), ("0",)), "female")
    gender = last_per_key(users, "user_id", ["gender"]).select("user_id", seg.alias("segment"))
    age = last_per_key(users.where(F.col("age").isNotNull()), "user_id", ["age"])
    band = age.select("user_id", "age", bucketize("age", (18, 35, 50), ("0-18", "18-35", "35-50", "50+")).alias("band"))
    return gender.join(band, "user_id", "left")


def q_rate_parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average and count per movie from the rating lines: unparsable ratings
    count nowhere, movies without a usable one give no row."""
    parsed = parse_ratings(_lines(load_table(spark, sf_dir, "lineitem"), RATING_LINE))
    usable = parsed.withColumn("rating", F.when(_kind(F.col("rating")) == "number", F.col("rating")))
    return rate_entities(usable, parse_movies(_lines(load_table(spark, sf_dir, "part"), MOVIE_LINE)))


def q_safe_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Special words and unparsable values through the safe casts."""
    part = load_table(spark, sf_dir, "part")
    words = ("nan", "NaN", "inf", "Infinity", "-Infinity", "INFINITY", "+Infinity", "1e3", "12", "12.5", "x")
    word = F.element_at(F.array(*map(F.lit, words)), (F.col("p_partkey") % len(words) + 1).cast("int"))
    number = safe_double(word)
    return part.select(
        "p_partkey", F.when(_kind(number) == "number", number).alias("number"), _kind(number).alias("kind"), safe_int(word).alias("whole")
    )


def _edge_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("user_id"), F.col("l_partkey").alias("movie_id"), F.expr(RATING_EDGE).alias("rating")
    )


def _edge_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every thirteenth part is missing, every third is there twice (the
    second time with another title)."""
    part = load_table(spark, sf_dir, "part").where("p_partkey % 13 != 0")
    cols = [F.col("p_partkey").alias("movie_id"), F.expr(GENRES_EDGE).alias("genres")]
    again = part.where("p_partkey % 3 = 0").select(*cols, F.concat("p_name", F.lit(" again")).alias("title"))
    return part.select(*cols, F.col("p_name").alias("title")).unionByName(again)


def q_valid_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of which two fifths are NULL or empty."""
    docs = load_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.expr(TEXT_EDGE).alias("review"))
    return valid_reviews(docs).select("id", F.length("review").alias("chars"))


def q_rate_entities_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL ratings, movies with none but NULL, repeated and missing movies."""
    return rate_entities(_edge_ratings(spark, sf_dir), _edge_movies(spark, sf_dir))


def q_rate_tags_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placeholder, empty, separator-only, inner-empty and untrimmed tags."""
    return rate_tags(_edge_ratings(spark, sf_dir), _edge_movies(spark, sf_dir))


def q_rate_by_segment_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users outside the dimension, mixed-case labels, movies with one
    segment only."""
    orders = load_table(spark, sf_dir, "orders").where("o_orderkey % 5 != 0")
    users = orders.join(load_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    seg = F.expr(SEGMENT_EDGE)
    users = users.select(
        F.col("o_orderkey").alias("user_id"),
        F.when(in_synonyms(seg, roles.MALE_SEGMENTS), "male").when(in_synonyms(seg, roles.FEMALE_SEGMENTS), "female").alias("segment"),
    )
    few = _edge_ratings(spark, sf_dir).where("movie_id % 10 != 0 OR user_id % 4 = 1")
    return rate_by_segment(few, users, roles.GENDER_LABELS, _edge_movies(spark, sf_dir))


def q_bucketize_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances on the band edges, just above one, and NULL."""
    cust = load_table(spark, sf_dir, "customer").select("c_custkey", F.expr(BALANCE_EDGE).alias("balance"))
    return cust.select("c_custkey", bucketize("balance", roles.BALANCE_EDGES, roles.BALANCE_LABELS).alias("band"))


def q_one_per_key_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating rows joined with a movie table that repeats and lacks keys."""
    items = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("movie_id"))
    dim = one_per_key(_edge_movies(spark, sf_dir).select("movie_id", "title"), "movie_id", ["title"])
    return left_join_default(items, dim, "movie_id", {"title": UNKNOWN_TITLE}, hot_keys=True)


# Ratings of tenths, whose doubles are not exact and whose sums round.
TENTHS = "(l_quantity % 10 + 1) / CAST(10 AS DOUBLE)"


def _tenths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every movie twice, the second time under the negative number: two
    equal bags of ratings, read from different places of the input."""
    items = load_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("user_id"), F.col("l_partkey").alias("movie_id"), F.expr(TENTHS).alias("rating")
    )
    return items.unionByName(items.withColumn("movie_id", -F.col("movie_id") - 1))


def q_exact_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages of fractional ratings, to the last bit, whatever the order in
    which partial results arrive."""
    return rate_entities(_tenths(spark, sf_dir), roles.movies(spark, sf_dir))


def q_best_of_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best movie where every movie has a twin with the same ratings: the
    tie goes to the smaller number."""
    stats = rating_stats(_tenths(spark, sf_dir))
    return top_rated(stats, roles.TOP_RATED_MIN_SUPPORT, movies=roles.movies(spark, sf_dir))


def q_exact_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag averages of fractional ratings: the exact parts of the movies' sums
    are added up, not their rounded sums."""
    return rate_tags(_tenths(spark, sf_dir), roles.movies(spark, sf_dir), sep=" ")


def q_exact_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment averages of fractional ratings."""
    segments = roles.gender_segments(spark, sf_dir)
    return rate_by_segment(_tenths(spark, sf_dir), segments, roles.GENDER_LABELS, roles.movies(spark, sf_dir))


def _positioned(df: DataFrame) -> DataFrame:
    """``df`` with the place of each row in its own order. For the few rows of
    an aggregated report: the numbering is one task's work."""
    return df.withColumn("_at", F.monotonically_increasing_id()).withColumn(
        "position", F.row_number().over(Window.orderBy("_at"))
    ).drop("_at")


def q_count_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews per aspect, with each row's place in the result (most frequent
    first, ties by aspect; the labels have mixed case)."""
    docs = load_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("doc_id") % 2 == 0, F.upper("source")).otherwise(F.col("source")).alias("aspect"),
    )
    counts = count_by(docs, [F.lower("aspect").alias("aspect")], "id", name="total")
    return _positioned(counts.orderBy(F.desc("total"), F.asc("aspect")))


def q_tag_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags with each row's place in the result (by tag)."""
    return _positioned(rate_tags(_edge_ratings(spark, sf_dir), _edge_movies(spark, sf_dir)).select("genre", "n"))


EDGE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_movie_lines": q_parse_movie_lines,
    "parse_rating_lines": q_parse_rating_lines,
    "parse_user_lines": q_parse_user_lines,
    "rate_parsed_lines": q_rate_parsed_lines,
    "safe_numbers": q_safe_numbers,
    "valid_edges": q_valid_edges,
    "rate_entities_edges": q_rate_entities_edges,
    "rate_tags_edges": q_rate_tags_edges,
    "rate_by_segment_edges": q_rate_by_segment_edges,
    "bucketize_edges": q_bucketize_edges,
    "one_per_key_edges": q_one_per_key_edges,
    "count_order": q_count_order,
    "tag_order": q_tag_order,
    "exact_averages": q_exact_averages,
    "best_of_ties": q_best_of_ties,
    "exact_tags": q_exact_tags,
    "exact_segments": q_exact_segments,
}

# -- the same in SQL ----------------------------------------------------------


def _trim(expr: str) -> str:
    return f"regexp_replace({expr}, '^[\\x00-\\x20]+|[\\x00-\\x20]+\\z', '', 'g')"


_MOVIE_LINES = f"""
ml AS (SELECT {MOVIE_LINE} AS value FROM part),
ms AS (SELECT string_split(rtrim(value, ','), ',') AS f FROM ml WHERE contains(value, ',')),
mp AS (
  SELECT {_trim('f[1]')} AS movie_id,
         CASE WHEN len(f) >= 3 THEN {_trim("array_to_string(f[2:len(f) - 1], ',')")}
              WHEN len(f) = 2 THEN {_trim('f[2]')} ELSE '' END AS title,
         CASE WHEN len(f) >= 3 THEN {_trim('f[len(f)]')} END AS genres
  FROM ms
)"""

_RATING_LINES = f"""
rl AS (SELECT string_split(rtrim({RATING_LINE}, ','), ',') AS f FROM lineitem),
rp AS (
  SELECT {_trim('f[1]')} AS user_id, {_trim('f[2]')} AS movie_id, {_trim('f[3]')} AS r,
         TRY_CAST({_trim('f[4]')} AS BIGINT) AS ts
  FROM rl WHERE len(f) >= 3
),
rk AS (
  SELECT user_id, movie_id, ts,
         CASE WHEN r = '4.0d' THEN 4.0 WHEN regexp_matches(r, '^[0-9.]+$') THEN TRY_CAST(r AS DOUBLE) END AS rating,
         CASE r WHEN 'NaN' THEN 'NaN' WHEN 'Infinity' THEN 'inf' WHEN '-Infinity' THEN '-inf' END AS word
  FROM rp
)"""

_EDGE_RATED = f"SELECT l_orderkey AS user_id, l_partkey AS movie_id, {RATING_EDGE} AS rating FROM lineitem"
_EDGE_MOVIES = f"""
  SELECT p_partkey AS movie_id, {GENRES_EDGE} AS genres, p_name AS title FROM part WHERE p_partkey % 13 <> 0
  UNION ALL
  SELECT p_partkey, {GENRES_EDGE}, p_name || ' again' FROM part WHERE p_partkey % 13 <> 0 AND p_partkey % 3 = 0"""
_EDGE_DIM = f"SELECT movie_id, max(title) AS title, max(genres) AS genres FROM ({_EDGE_MOVIES}) GROUP BY movie_id"

_TAGS_SQL = f"""
WITH per AS (SELECT movie_id, sum(rating) AS s, count(rating) AS n FROM ({_EDGE_RATED}) GROUP BY movie_id),
d AS ({_EDGE_DIM}),
t AS (
  SELECT unnest(CASE WHEN rtrim(genres, '|') = '' THEN []::VARCHAR[] ELSE string_split(rtrim(genres, '|'), '|') END) AS g, s, n
  FROM per JOIN d USING (movie_id) WHERE n > 0 AND genres <> '' AND genres <> '(no genres listed)'
)
SELECT {_trim('g')} AS genre, sum(s) / sum(n) AS avg_rating, CAST(sum(n) AS BIGINT) AS n FROM t GROUP BY 1
"""


_TENTHS_ROWS = f"""
  SELECT l_orderkey AS user_id, l_partkey AS movie_id, {TENTHS} AS rating FROM lineitem
  UNION ALL SELECT l_orderkey, -l_partkey - 1, {TENTHS} FROM lineitem"""


def _steps(rating: str) -> str:
    """The exact sum, in steps of 2^-72, of ratings that are not negative."""
    return f"sum(CAST({rating} * pow(2, 72) AS HUGEINT))"


def _from_steps(steps: str, n: str) -> str:
    """A sum of such steps as a double, divided once."""
    return (
        f"(CAST({steps} // 281474976710656 AS DOUBLE) / pow(2, 24) + CAST({steps} % 281474976710656 AS DOUBLE) / pow(2, 72)) / {n}"
    )


_TENTHS_RATED = f"""
r AS (SELECT movie_id, {_steps('rating')} AS s, count(rating) AS n FROM ({_TENTHS_ROWS}) GROUP BY movie_id),
d AS (SELECT p_partkey AS movie_id, max(p_name) AS title FROM part GROUP BY p_partkey),
a AS (
  SELECT movie_id, coalesce(title, 'Unknown Movie') AS title, {_from_steps('s', 'n')} AS avg_rating, n
  FROM r LEFT JOIN d USING (movie_id)
)"""


def _band(col: str, edges, labels) -> str:
    parts = " ".join(f"WHEN {col} <= {e} THEN '{lab}'" for e, lab in zip(edges, labels))
    return f"CASE WHEN {col} IS NULL THEN NULL {parts} ELSE '{labels[-1]}' END"


def _words(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


EDGE_SQL: dict[str, str] = {
    "parse_movie_lines": f"WITH {_MOVIE_LINES.strip()} SELECT movie_id, title, genres FROM mp",
    "parse_rating_lines": f"""
WITH {_RATING_LINES.strip()}
SELECT user_id, movie_id, rating, CASE WHEN rating IS NOT NULL THEN 'number' ELSE coalesce(word, 'none') END AS kind, ts FROM rk
""",
    "parse_user_lines": f"""
WITH l AS (
  SELECT 1 AS no, {USER_LINE} AS value FROM customer
  UNION ALL SELECT 2, {USER_AGAIN} FROM customer WHERE c_custkey % 5 = 0
),
p AS (SELECT no, string_split(rtrim(value, ','), ',') AS f FROM l),
u AS (
  SELECT no, {_trim('f[1]')} AS user_id, {_trim('f[2]')} AS gender,
         CASE WHEN regexp_matches({_trim('f[3]')}, '^[0-9]+$') THEN CAST({_trim('f[3]')} AS INTEGER) END AS age
  FROM p WHERE len(f) >= 2
),
g AS (SELECT user_id, arg_max(gender, no) AS gender FROM u GROUP BY user_id),
a AS (SELECT user_id, arg_max(age, no) AS age FROM u WHERE age IS NOT NULL GROUP BY user_id)
SELECT user_id, CASE WHEN upper(gender) IN ('M', 'MALE') OR gender = '1' THEN 'male'
                     WHEN upper(gender) IN ('F', 'FEMALE') OR gender = '0' THEN 'female' END AS segment,
       age, {_band('age', (18, 35, 50), ('0-18', '18-35', '35-50', '50+'))} AS band
FROM g LEFT JOIN a USING (user_id)
""",
    "rate_parsed_lines": f"""
WITH {_MOVIE_LINES.strip()}, {_RATING_LINES.strip()},
d AS (SELECT movie_id, max(title) AS title FROM mp GROUP BY movie_id),
r AS (SELECT movie_id, avg(rating) AS avg_rating, count(rating) AS n FROM rk GROUP BY movie_id HAVING count(rating) > 0)
SELECT movie_id, coalesce(title, 'Unknown Movie') AS title, avg_rating, n FROM r LEFT JOIN d USING (movie_id)
""",
    "safe_numbers": """
SELECT p_partkey,
       CASE p_partkey % 11 WHEN 7 THEN 1000.0 WHEN 8 THEN 12.0 WHEN 9 THEN 12.5 END::DOUBLE AS number,
       CASE p_partkey % 11 WHEN 1 THEN 'NaN' WHEN 3 THEN 'inf' WHEN 4 THEN '-inf' WHEN 6 THEN 'inf'
            WHEN 7 THEN 'number' WHEN 8 THEN 'number' WHEN 9 THEN 'number' ELSE 'none' END AS kind,
       CASE p_partkey % 11 WHEN 8 THEN 12 END::INTEGER AS whole
FROM part
""",
    "valid_edges": "SELECT doc_id AS id, CAST(length(text) AS INTEGER) AS chars FROM documents WHERE doc_id % 5 > 1 AND text <> ''",
    "rate_entities_edges": f"""
WITH r AS (
  SELECT movie_id, avg(rating) AS avg_rating, count(rating) AS n FROM ({_EDGE_RATED}) GROUP BY movie_id HAVING count(rating) > 0
), d AS ({_EDGE_DIM})
SELECT movie_id, coalesce(title, 'Unknown Movie') AS title, avg_rating, n FROM r LEFT JOIN d USING (movie_id)
""",
    "rate_tags_edges": _TAGS_SQL,
    "rate_by_segment_edges": f"""
WITH u AS (
  SELECT o_orderkey AS user_id, upper({SEGMENT_EDGE}) AS s FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 5 <> 0
), d AS ({_EDGE_DIM}), j AS (
  SELECT r.movie_id, r.rating, CASE WHEN s IN ({_words(roles.MALE_SEGMENTS)}) THEN 'male'
                                    WHEN s IN ({_words(roles.FEMALE_SEGMENTS)}) THEN 'female' END AS segment
  FROM ({_EDGE_RATED}) r JOIN u USING (user_id) WHERE r.movie_id % 10 <> 0 OR r.user_id % 4 = 1
), a AS (
  SELECT movie_id, avg(rating) FILTER (segment = 'male') AS avg_male, avg(rating) FILTER (segment = 'female') AS avg_female
  FROM j GROUP BY movie_id
)
SELECT movie_id, coalesce(title, 'Unknown Movie') AS title, avg_male, avg_female
FROM a LEFT JOIN d USING (movie_id) WHERE avg_male IS NOT NULL OR avg_female IS NOT NULL
""",
    "bucketize_edges": f"""
SELECT c_custkey, {_band('b', roles.BALANCE_EDGES, roles.BALANCE_LABELS)} AS band FROM (SELECT c_custkey, {BALANCE_EDGE} AS b FROM customer)
""",
    "one_per_key_edges": f"""
WITH d AS ({_EDGE_DIM})
SELECT l_orderkey, l_linenumber, l_partkey AS movie_id, coalesce(title, 'Unknown Movie') AS title
FROM lineitem LEFT JOIN d ON l_partkey = movie_id
""",
    "count_order": """
WITH c AS (SELECT lower(source) AS aspect, count(doc_id) AS total FROM documents GROUP BY 1)
SELECT aspect, total, CAST(row_number() OVER (ORDER BY total DESC, aspect NULLS FIRST) AS INTEGER) AS position FROM c
""",
    "tag_order": f"""
WITH t AS ({_TAGS_SQL})
SELECT genre, n, CAST(row_number() OVER (ORDER BY genre) AS INTEGER) AS position FROM t
""",
    "exact_averages": f"WITH {_TENTHS_RATED.strip()} SELECT movie_id, title, avg_rating, n FROM a",
    "best_of_ties": f"""
WITH {_TENTHS_RATED.strip()}
SELECT movie_id, title, avg_rating, n FROM a WHERE n >= {roles.TOP_RATED_MIN_SUPPORT} ORDER BY avg_rating DESC, movie_id LIMIT 1
""",
    "exact_tags": f"""
WITH {_TENTHS_RATED.strip()},
t AS (
  SELECT unnest(string_split(rtrim(title, ' '), ' ')) AS genre, s, n FROM r JOIN d USING (movie_id) WHERE title <> ''
), u AS (SELECT trim(genre) AS genre, sum(s) AS s, CAST(sum(n) AS BIGINT) AS n FROM t GROUP BY 1)
SELECT genre, {_from_steps('s', 'n')} AS avg_rating, n FROM u
""",
    "exact_segments": f"""
WITH {_TENTHS_RATED.strip()},
u AS (SELECT o_orderkey AS user_id, upper(c_mktsegment) AS g FROM orders JOIN customer ON o_custkey = c_custkey),
j AS (
  SELECT movie_id, g IN ({_words(roles.MALE_SEGMENTS)}) AS male, g IN ({_words(roles.FEMALE_SEGMENTS)}) AS female, rating
  FROM ({_TENTHS_ROWS}) JOIN u USING (user_id)
), g AS (
  SELECT movie_id, {_steps('rating')} FILTER (male) AS sm, {_steps('rating')} FILTER (female) AS sf,
         count(*) FILTER (male) AS nm, count(*) FILTER (female) AS nf
  FROM j GROUP BY movie_id
)
SELECT movie_id, coalesce(title, 'Unknown Movie') AS title,
       CASE WHEN nm > 0 THEN {_from_steps('sm', 'nm')} END AS avg_male, CASE WHEN nf > 0 THEN {_from_steps('sf', 'nf')} END AS avg_female
FROM g LEFT JOIN d USING (movie_id) WHERE nm + nf > 0
""",
}
