"""Equivalent SQL for each named query, runnable by DuckDB on the same tables.

Written independently of the Spark operators, straight from the semantics;
column names match the Spark results. Regular expressions use RE2 syntax:
``[[:punct:]]`` is the same ASCII punctuation set as Java's ``\\p{Punct}``.
"""

from __future__ import annotations

from sparktally.plans import roles


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# The five cleaning steps and the trim, spelt as they are.
def _clean(col: str) -> str:
    c = f"lower({col})"
    c = f"regexp_replace({c}, '[-^]', ' ', 'g')"
    c = f"regexp_replace({c}, '[[:punct:]]', '', 'g')"
    c = f"regexp_replace({c}, '[0-9]', '', 'g')"
    c = f"regexp_replace({c}, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')"
    return f"regexp_replace({c}, '^[\\x00-\\x20]+|[\\x00-\\x20]+\\z', '', 'g')"


_STOP_VALUES = ", ".join("('" + w.replace("'", "''") + "')" for w in roles.STOPWORDS)

_RATED = """
rated AS (
  SELECT l_partkey AS movie_id, avg(l_quantity) AS avg_rating, count(l_quantity) AS n,
         sum(l_quantity) AS s
  FROM lineitem GROUP BY l_partkey HAVING count(l_quantity) > 0
)"""

_MOVIES = """
mv AS (SELECT p_partkey AS movie_id, max(p_name) AS title FROM part GROUP BY p_partkey)"""

_KNOWN = f"""
mv AS (
  SELECT p_partkey AS movie_id, max(p_name) AS title
  FROM part WHERE p_size <= {roles.MOVIE_MAX_SIZE} GROUP BY p_partkey
)"""

_SENTIMENT = """
lab AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
rev AS (
  SELECT d.doc_id AS id, d.text AS review, d.lang AS category, d.source AS aspect,
         CASE lab.quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' END AS sentiment
  FROM documents d LEFT JOIN lab ON d.doc_id = lab.doc_id
)"""

_TOKENS = f"""
{_SENTIMENT.strip()},
cleaned AS (
  SELECT id, {_clean('review')} AS review, lower(category) AS category,
         lower(aspect) AS aspect, lower(sentiment) AS sentiment
  FROM rev WHERE review IS NOT NULL AND review <> ''
),
all_tokens AS (
  SELECT * FROM (
    SELECT id, unnest(string_split(review, ' ')) AS word, category, aspect, sentiment FROM cleaned
  ) WHERE word <> ''
),
stop AS (SELECT DISTINCT stopword FROM (VALUES {_STOP_VALUES}) AS t(stopword)),
tokens AS (
  SELECT * FROM all_tokens WHERE word NOT IN (SELECT stopword FROM stop)
)"""


def _segment_sql(seg_expr: str, labels: tuple[str, ...], cust_cols: str) -> str:
    aggs = ",\n    ".join(
        f"avg(CASE WHEN u.segment = '{lab}' THEN l.l_quantity END) AS avg_{lab},\n"
        f"    count(CASE WHEN u.segment = '{lab}' THEN l.l_quantity END) AS n_{lab}"
        for lab in labels
    )
    any_rated = " OR ".join(f"a.n_{lab} > 0" for lab in labels)
    avg_cols = ", ".join(f"a.avg_{lab}" for lab in labels)
    return f"""
WITH {_MOVIES.strip()},
u AS (
  SELECT o.o_orderkey AS user_id, {seg_expr} AS segment
  FROM orders o JOIN (SELECT c_custkey, {cust_cols} FROM customer) c ON o.o_custkey = c.c_custkey
),
a AS (
  SELECT l.l_partkey AS movie_id,
    {aggs}
  FROM lineitem l JOIN u ON l.l_orderkey = u.user_id
  WHERE u.segment IN ({_in_list(labels)})
  GROUP BY l.l_partkey
)
SELECT a.movie_id, coalesce(mv.title, 'Unknown Movie') AS title, {avg_cols}
FROM a LEFT JOIN mv ON a.movie_id = mv.movie_id
WHERE {any_rated}
ORDER BY a.movie_id
"""


def _gender_expr() -> str:
    return (
        f"CASE WHEN upper(c.c_mktsegment) IN ({_in_list(roles.MALE_SEGMENTS)}) THEN 'male' "
        f"WHEN upper(c.c_mktsegment) IN ({_in_list(roles.FEMALE_SEGMENTS)}) THEN 'female' END"
    )


def _band_expr(col: str) -> str:
    parts = " ".join(
        f"WHEN {col} <= {edge} THEN '{lab}'" for edge, lab in zip(roles.BALANCE_EDGES, roles.BALANCE_LABELS)
    )
    return f"CASE WHEN {col} IS NULL THEN NULL {parts} ELSE '{roles.BALANCE_LABELS[-1]}' END"


def _top_words_sql(sentiment: str | None, name: str) -> str:
    where = "" if sentiment is None else f"WHERE sentiment = '{sentiment}'"
    return f"""
WITH {_TOKENS.strip()},
counts AS (SELECT category, word, count(id) AS {name} FROM tokens {where} GROUP BY category, word),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY {name} DESC, word) AS rk FROM counts
)
SELECT category, word, {name} FROM ranked WHERE rk <= {roles.TOP_WORDS_K}
ORDER BY category NULLS FIRST, rk
"""


def _top_aspect_sql(sentiment: str) -> str:
    return f"""
WITH {_SENTIMENT.strip()},
v AS (
  SELECT lower(aspect) AS aspect, lower(sentiment) AS sentiment
  FROM rev WHERE review IS NOT NULL AND review <> ''
)
SELECT aspect, count(aspect) AS total FROM v WHERE sentiment = '{sentiment}'
GROUP BY aspect ORDER BY total DESC, aspect NULLS FIRST LIMIT 1
"""


def _count_reviews_sql(src: str, name: str) -> str:
    return f"""
SELECT lower({src}) AS {name}, count(doc_id) AS total_comments
FROM documents WHERE text IS NOT NULL AND text <> ''
GROUP BY lower({src}) ORDER BY total_comments DESC, {name} NULLS FIRST
"""


_WORD_FREQ = f"""
WITH {_TOKENS.strip()}
SELECT word, count(id) AS freq FROM tokens GROUP BY word
HAVING count(id) > {roles.FREQUENT_MIN_EXCLUSIVE}
ORDER BY freq DESC, word
"""

def _two_decimals(expr: str) -> str:
    """Half-up rounding of the shortest decimal form, then two decimals."""
    return f"printf('%.2f', round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 10)), 2))"


def _band_cells() -> str:
    cells = ", ".join(
        f"CASE WHEN avg_{lab} IS NULL THEN 'NA' ELSE {_two_decimals(f'avg_{lab}')} END"
        for lab in roles.BALANCE_LABELS
    )
    fmt = " ".join(f"{lab}: %-4s" for lab in roles.BALANCE_LABELS)
    return f"printf('{fmt}', {cells})"


ORACLE_SQL: dict[str, str] = {
    "rate_entities": f"""
WITH {_RATED.strip()}, {_KNOWN.strip()}
SELECT r.movie_id, coalesce(mv.title, 'Unknown Movie') AS title, r.avg_rating, r.n
FROM rated r LEFT JOIN mv ON r.movie_id = mv.movie_id
ORDER BY r.movie_id
""",
    "top_rated": f"""
WITH {_RATED.strip()}, {_MOVIES.strip()}
SELECT r.movie_id, coalesce(mv.title, 'Unknown Movie') AS title, r.avg_rating, r.n
FROM rated r LEFT JOIN mv ON r.movie_id = mv.movie_id
WHERE r.n >= {roles.TOP_RATED_MIN_SUPPORT} AND NOT isnan(r.avg_rating)
ORDER BY r.avg_rating DESC, r.movie_id LIMIT 1
""",
    "rate_tags": f"""
WITH {_RATED.strip()},
g AS (
  SELECT p_partkey AS movie_id, max(p_name) AS genres
  FROM part WHERE p_name IS NOT NULL GROUP BY p_partkey
),
t AS (
  SELECT unnest(CASE WHEN rtrim(g.genres, ' ') = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(g.genres, ' '), ' ') END) AS genre,
         r.s, r.n
  FROM rated r JOIN g ON r.movie_id = g.movie_id
  WHERE g.genres <> '' AND g.genres <> '(no genres listed)'
)
SELECT trim(genre) AS genre, sum(s) / sum(n) AS avg_rating, CAST(sum(n) AS BIGINT) AS n
FROM t GROUP BY trim(genre) ORDER BY genre
""",
    "rate_by_segment_two": _segment_sql(_gender_expr(), roles.GENDER_LABELS, "c_mktsegment"),
    "rate_by_band": _segment_sql(_band_expr("c.c_acctbal"), roles.BALANCE_LABELS, "c_acctbal"),
    "clean_tokens": f"""
WITH {_TOKENS.strip()}
SELECT id, word, category, aspect, sentiment FROM all_tokens
""",
    "remove_stopwords": f"""
WITH {_TOKENS.strip()}
SELECT id, word, category, aspect, sentiment FROM tokens
""",
    "frequent_words": _WORD_FREQ,
    "ordered_limit": _WORD_FREQ + " LIMIT 10",
    "count_by_category": _count_reviews_sql("lang", "category"),
    "count_by_aspect": _count_reviews_sql("source", "aspect"),
    "top_source_positive": _top_aspect_sql("positive"),
    "top_source_negative": _top_aspect_sql("negative"),
    "top5_words_positive": _top_words_sql("positive", "total"),
    "top5_words_negative": _top_words_sql("negative", "total"),
    "top5_words": _top_words_sql(None, "total_freq"),
    "union_inputs": """
SELECT movie_id, avg(rating) AS avg_rating, count(rating) AS n FROM (
  SELECT l_partkey AS movie_id, l_quantity AS rating FROM lineitem
  WHERE l_shipdate < TIMESTAMP '1998-01-01'
  UNION ALL
  SELECT l_partkey AS movie_id, l_quantity AS rating FROM lineitem
  WHERE NOT (l_shipdate < TIMESTAMP '1998-01-01') OR l_shipdate IS NULL
) GROUP BY movie_id
""",
    "filter_valid": f"""
SELECT doc_id AS id, CAST(length({_clean('text')}) AS INTEGER) AS clean_chars
FROM documents WHERE text IS NOT NULL AND text <> ''
""",
    "left_join_default": f"""
WITH {_KNOWN.strip()}
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS movie_id,
       coalesce(mv.title, 'Unknown Movie') AS title
FROM lineitem l LEFT JOIN mv ON l.l_partkey = mv.movie_id
""",
    "anti_join": f"""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE NOT EXISTS (
  SELECT 1 FROM part p WHERE p.p_size <= {roles.MOVIE_MAX_SIZE} AND p.p_partkey = l.l_partkey
)
""",
    "safe_cast": """
SELECT p_partkey,
       TRY_CAST(regexp_extract(p_brand, '#([^#]*)$', 1) AS INTEGER) AS brand_no,
       TRY_CAST(p_name AS INTEGER) AS name_no
FROM part
""",
    "explode_list": """
SELECT p_partkey, trim(tag) AS tag FROM (
  SELECT p_partkey, unnest(CASE WHEN rtrim(p_name, ' ') = '' THEN []::VARCHAR[]
                               ELSE string_split(rtrim(p_name, ' '), ' ') END) AS tag
  FROM part WHERE p_name IS NOT NULL
)
""",
    "bucketize": f"""
SELECT c_custkey, {_band_expr('c_acctbal')} AS band FROM customer
""",
    "conditional_avg": """
SELECT l_partkey AS movie_id,
       avg(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS avg_a,
       avg(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS avg_n,
       avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS avg_r
FROM lineitem GROUP BY l_partkey
""",
    "group_collect": f"""
WITH top AS ({_top_words_sql(None, "total_freq")})
SELECT category, string_agg(word || ':' || CAST(total_freq AS VARCHAR), ',' ORDER BY total_freq DESC, word)
       AS words
FROM top GROUP BY category
""",
    "word_counts": f"""
SELECT id, CAST(len(list_filter(string_split(review, ' '), lambda w: w <> '')) AS INTEGER) AS n_words FROM (
  SELECT doc_id AS id, {_clean('text')} AS review FROM documents WHERE text IS NOT NULL AND text <> ''
)
""",
    "movie_report": f"""
WITH {_RATED.strip()}, {_KNOWN.strip()}
SELECT coalesce(mv.title, 'Unknown Movie') AS title,
       printf('AverageRating: %s (TotalRatings: %d)', {_two_decimals('r.avg_rating')}, r.n) AS line,
       r.movie_id
FROM rated r LEFT JOIN mv ON r.movie_id = mv.movie_id
""",
    "band_report": f"""
WITH b AS ({_segment_sql(_band_expr("c.c_acctbal"), roles.BALANCE_LABELS, "c_acctbal")})
SELECT printf('%-30s', title) AS title, {_band_cells()} AS line, movie_id FROM b
""",
    "best_report": f"""
WITH {_RATED.strip()}, {_MOVIES.strip()},
best AS (
  SELECT coalesce(mv.title, 'Unknown Movie') AS title, r.avg_rating
  FROM rated r LEFT JOIN mv ON r.movie_id = mv.movie_id
  WHERE r.n >= {roles.TOP_RATED_MIN_SUPPORT} AND NOT isnan(r.avg_rating)
  ORDER BY r.avg_rating DESC, r.movie_id LIMIT 1
)
SELECT printf('%s is the highest rated movie with an average rating of %s among movies with at least %d ratings.',
              title, {_two_decimals('avg_rating')}, {roles.TOP_RATED_MIN_SUPPORT}) AS line
FROM best
""",
}

ORACLE_SQL["genre_report"] = f"""
WITH t AS ({ORACLE_SQL["rate_tags"]})
SELECT genre, printf('Avg: %s, Count: %d', {_two_decimals('avg_rating')}, n) AS line FROM t
"""
ORACLE_SQL["gender_report"] = f"""
WITH g AS ({ORACLE_SQL["rate_by_segment_two"]})
SELECT printf('%-35s', title) AS title,
       printf('Male: %s, Female: %s',
              CASE WHEN avg_male IS NULL THEN 'N/A ' ELSE {_two_decimals('avg_male')} END,
              CASE WHEN avg_female IS NULL THEN 'N/A ' ELSE {_two_decimals('avg_female')} END) AS line,
       movie_id
FROM g
"""
