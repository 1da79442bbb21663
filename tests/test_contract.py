"""The driver contract: entry(), queries() and oracle_sql() agree.

Every query runs on the smallest data directory and is compared with its
SQL in DuckDB (row count, column names, values after sorting)."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as contract
from sparktally.plans import ORACLE_SQL, QUERIES
from sparktally.sources.tables import TABLES, table_path
from tests.conftest import SF_SMOKE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMOKE, t)}')")
    yield c
    c.close()


def _norm(v):
    # Exact comparison: averages are sums of whole numbers divided once, so
    # both engines produce the same double, bit for bit.
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["movie_id", "title", "avg_rating", "n"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = contract.queries()[name](spark, SF_SMOKE)
    got = _rows(df.collect(), df.columns)
    res = con.execute(contract.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == _rows(res.fetchall(), cols)


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def test_oracle_types_match(spark, con):
    for name, fn in QUERIES.items():
        spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                       for f in fn(spark, SF_SMOKE).schema.fields}
        rel = con.sql(contract.oracle_sql()[name])
        assert spark_types == {n: str(t) for n, t in zip(rel.columns, rel.types)}, name


@pytest.mark.parametrize("name", ["union_inputs", "rate_tags", "top5_words_positive"])
def test_results_do_not_depend_on_session_zone_or_ansi(spark, con, name):
    keys = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        df = contract.queries()[name](spark, SF_SMOKE)
        got = _rows(df.collect(), df.columns)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    res = con.execute(contract.oracle_sql()[name])
    assert got == _rows(res.fetchall(), [d[0] for d in res.description])


def test_text_invariants_on_test_tables(spark):
    from sparktally.plans.roles import STOPWORDS

    q = contract.queries()

    def rows(name):
        return q[name](spark, SF_SMOKE).collect()

    cat = {r.category: r.total_comments for r in rows("count_by_category")}
    asp = {r.aspect: r.total_comments for r in rows("count_by_aspect")}
    assert sum(cat.values()) == sum(asp.values())
    for sentiment in ("positive", "negative"):
        top = rows(f"top_source_{sentiment}")[0]
        assert top.total <= asp[top.aspect]
    pos = {(r.category, r.word): r.total for r in rows("top5_words_positive")}
    neg = {(r.category, r.word): r.total for r in rows("top5_words_negative")}
    allw = {(r.category, r.word): r.total_freq for r in rows("top5_words")}
    for key in set(pos) & set(neg) & set(allw):
        assert pos[key] + neg[key] <= allw[key]
    freq = {r.word: r.freq for r in rows("frequent_words")}
    assert not set(freq) & set(STOPWORDS)
    assert [r.word for r in rows("ordered_limit")] == [w for w, _ in sorted(freq.items(), key=lambda x: (-x[1], x[0]))][:10]
