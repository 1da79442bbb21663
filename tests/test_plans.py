"""Physical plan shapes the operators are built for."""

from __future__ import annotations

import pytest

from sparktally.plans import QUERIES
from tests.conftest import SF_SMOKE


def _plan(spark, name):
    df = QUERIES[name](spark, SF_SMOKE)
    return df._jdf.queryExecution().executedPlan().toString()


def test_stopwords_are_an_anti_join(spark):
    plan = _plan(spark, "remove_stopwords")
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan  # a literal list, of known size
    assert "LeftOuter" in plan  # labels join at document level, before the explode


def test_top_k_per_group_limits_before_the_shuffle(spark):
    plan = _plan(spark, "top5_words")
    assert "WindowGroupLimit" in plan and ", Partial" in plan and ", Final" in plan
    assert plan.index(", Final") < plan.index(", Partial")  # Final is printed above (after) the exchange


def test_global_top_is_take_ordered(spark):
    for name in ("top_rated", "top_source_positive"):
        assert "TakeOrderedAndProject" in _plan(spark, name)


@pytest.mark.parametrize("name", ["rate_entities", "rate_by_band", "frequent_words", "count_by_aspect"])
def test_partial_aggregation(spark, name):
    assert "partial_" in _plan(spark, name)


def test_pushdown_and_pruning(spark):
    plan = _plan(spark, "rate_entities")
    assert "(p_size" in plan and "<= 40)" in plan
    assert "p_size" not in _plan(spark, "rate_tags")  # the whole movie table
    df = QUERIES["rate_entities"](spark, SF_SMOKE)
    formatted = df._jdf.queryExecution().executedPlan().treeString()
    assert "FileScan parquet [l_partkey" in formatted and "l_shipdate" not in formatted
    explain = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PushedFilters: [IsNotNull(p_size), LessThanOrEqual(p_size,40)" in explain
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in explain


def test_sentiment_filter_turns_label_join_inner(spark):
    plan = _plan(spark, "top5_words_positive")
    assert "LeftOuter" not in plan  # the positive-only filter makes the label join inner
    assert "WindowGroupLimit" in plan


def test_no_python_udf(spark):
    for name in QUERIES:
        plan = _plan(spark, name)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_no_query_spreads_its_input(spark):
    for name in QUERIES:
        assert "RoundRobinPartitioning" not in _plan(spark, name), name


def test_best_movie_looks_up_only_the_winner(spark):
    plan = _plan(spark, "top_rated")
    assert "LeftSemi" in plan  # the movie scan is filtered by the broadcast winning key
    assert plan.count("TakeOrderedAndProject") == 2


def test_tag_explode_has_no_lambda(spark):
    for name in ("rate_tags", "explode_list"):
        assert "transform(" not in _plan(spark, name), name  # lambdas run outside code generation
