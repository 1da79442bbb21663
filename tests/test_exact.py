"""Exact sums: the same bits in any order, checked against fractions."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from sparktally.functions import exact_avg, exact_sum
from sparktally.operators import rate_by_segment, rate_entities, rate_tags, rating_stats, top_rated

TENTHS = [0.1, 0.7, 0.3, 1.1, 4.9, 2.2, 3.6]


def _frame(spark, rows, schema, parts, seed):
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, schema).repartition(parts)


def _sum(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return df.agg(exact_sum("v").alias("s")).first().s


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_bits_do_not_depend_on_the_partitions(spark, parts):
    rng = random.Random(1)
    # Keys 2k and 2k + 1 hold the same ratings: ties of all pairs.
    bags = {k: [rng.choice(TENTHS) for _ in range(rng.randint(1, 60))] for k in range(40)}
    rows = [(f"u{i % 5}", 2 * k + twin, r) for k, bag in bags.items() for twin in (0, 1) for i, r in enumerate(bag)]
    ratings = _frame(spark, rows, "user_id string, movie_id long, rating double", parts, parts)
    got = {r.movie_id: r.avg_rating for r in rate_entities(ratings).collect()}
    for k, bag in bags.items():
        want = float(sum(map(Fraction, bag))) / len(bag)
        assert got[2 * k] == got[2 * k + 1] == want
    best = top_rated(rating_stats(ratings), 5).first()
    assert best.movie_id == min(m for m in got if got[m] == best.avg_rating)
    assert best.movie_id % 2 == 0

    movies = spark.createDataFrame([(m, f"t{m}", "a|b" if m % 2 else "b") for m in range(80)], "movie_id long, title string, genres string")
    tags = {r.genre: r for r in rate_tags(ratings, movies).collect()}
    every = [r for bag in bags.values() for r in bag]
    assert tags["a"].avg_rating == float(sum(map(Fraction, every))) / len(every)
    assert tags["b"].avg_rating == float(sum(map(Fraction, every)) * 2) / (2 * len(every))

    segments = spark.createDataFrame([(f"u{i}", "x" if i < 2 else "y") for i in range(5)], "user_id string, segment string")
    for r in rate_by_segment(ratings, segments, ("x", "y")).collect():
        bag = bags[r.movie_id // 2]
        for name, half in (("x", [v for i, v in enumerate(bag) if i % 5 < 2]), ("y", [v for i, v in enumerate(bag) if i % 5 >= 2])):
            assert r[f"avg_{name}"] == (float(sum(map(Fraction, half))) / len(half) if half else None)


def test_sums_are_correctly_rounded(spark):
    rng = random.Random(2)
    for _ in range(25):
        values = [rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randint(-5, 7) for _ in range(rng.randint(1, 30))]
        assert _sum(spark, values) == float(sum(map(Fraction, values)))
    assert _sum(spark, [1e16 / 2**25, 0.1, -(1e16 / 2**25)]) == 0.1
    assert _sum(spark, [-0.1, -0.7, 0.2]) == float(Fraction(-0.1) + Fraction(-0.7) + Fraction(0.2))
    assert _sum(spark, [-1.0, 2.0**-60]) == -1.0 + 2.0**-53 * 0
    assert _sum(spark, [2.0**-72, 2.0**-80]) == 2.0**-72  # beyond the last step


def test_large_and_special_values(spark):
    assert _sum(spark, [1e300, 2.5]) == 1e300
    assert _sum(spark, [float(2**31), 0.5]) == 2**31 + 0.5
    assert _sum(spark, [float("inf"), 1.0]) == math.inf
    assert math.isnan(_sum(spark, [float("inf"), float("-inf")]))
    assert math.isnan(_sum(spark, [float("nan"), 1.0]))
    assert _sum(spark, [float("inf")]) == math.inf
    assert _sum(spark, [None, None]) is None
    assert _sum(spark, [None, 0.5]) == 0.5
    assert _sum(spark, []) is None


def test_many_rows_of_the_largest_part_do_not_overflow(spark):
    df = spark.range(200_000).select(F.lit(2.0**31 - 2.0**-20).alias("v"))
    got = df.agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).first()
    assert got.s == 200_000 * (2.0**31 - 2.0**-20)
    assert got.a == 2.0**31 - 2.0**-20


def test_aggregation_stays_partial_and_generated(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") / 10).alias("v"))
    grouped = df.groupBy("k").agg(exact_avg("v").alias("a"))
    assert grouped.count() == 7
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and "partial_sum" in plan
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
