"""Join building blocks: dimension de-duplication, joins that can be split at
a hot key, outer join with defaults, anti-join.

No side is forced into a broadcast: Catalyst broadcasts a side whose
estimated size is below ``spark.sql.autoBroadcastJoinThreshold``, AQE one
whose measured size is, and otherwise the join is a sort-merge join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(dim: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """One row per key, each attribute its largest value.

    A dimension with a repeated key would otherwise multiply the fact rows
    in a join. The pick is deterministic. The aggregate leaves ``dim``
    hash-partitioned on ``key``, which a following sort-merge join on the
    same key reuses; that suits a fact side aggregated by the same key. For
    raw fact rows use ``splittable_join``.
    """
    return dim.groupBy(key).agg(*[F.max(c).alias(c) for c in cols])


def last_per_key(dim: DataFrame, key: str, cols: Sequence[str], order_col: str = "line_no") -> DataFrame:
    """One row per key: the values of the row with the largest ``order_col``
    ("the last line wins"; any orderable column, e.g. the (file, position)
    struct of ``read_lines``). ``max_by`` aggregates partially before the
    shuffle, so a key repeated on a third of the rows costs one row per
    task."""
    picked = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(order_col))
    return dim.groupBy(key).agg(picked.alias("_last")).select(key, *[F.col(f"_last.{c}").alias(c) for c in cols])


def splittable_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``fact`` JOIN ``dim`` USING ``key``, so that AQE can split a hot key.

    AQE splits a skewed partition only if both sides come straight from an
    exchange made for the join. A side that is already partitioned on the key
    (by an aggregate such as ``one_per_key``) gets none. The join therefore
    asks for the key and a hash of it, which both sides have to be shuffled
    by; equal keys have equal hashes, so the result is that of the plain join
    (NULL keys never match).
    """
    hashed = lambda df: df.withColumn("_key_hash", F.xxhash64(F.col(key).cast("string")))
    return hashed(fact).join(hashed(dim), on=[key, "_key_hash"], how=how).drop("_key_hash")


def left_join_default(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    defaults: Mapping[str, object],
    hot_keys: bool = False,
) -> DataFrame:
    """``fact`` LEFT OUTER JOIN ``dim`` USING ``key``; NULL attributes of
    unmatched rows replaced by ``defaults`` (column -> value).

    NULL keys never match. Columns of ``dim`` not in ``defaults`` stay NULL
    for unmatched rows. ``hot_keys``: ``fact`` holds raw rows, of which one
    key may have a large share (``splittable_join``).
    """
    joined = splittable_join(fact, dim, key, "left") if hot_keys else fact.join(dim, on=key, how="left")
    for col, value in defaults.items():
        joined = joined.withColumn(col, F.coalesce(F.col(col), F.lit(value)))
    return joined


def anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot_keys: bool = False) -> DataFrame:
    """Rows of ``left`` whose key has no equal in ``right`` (NOT EXISTS).

    Written as ``left_anti`` rather than outer join + IS NULL: the plan is a
    single anti-join that never materialises the joined rows. A NULL key on
    the right never matches; a NULL key on the left is kept.

    ``hot_keys``: ``right`` may be too long for a broadcast while one key has
    a large share of ``left``. As in ``splittable_join`` both sides are then
    shuffled by the key and a hash of it, so that a following aggregate by the
    key does not tie AQE to one task per key.
    """
    r = right.select(F.col(right_key).alias("_anti_key"))
    match = F.col(left_key) == F.col("_anti_key")
    if hot_keys:
        hashed = lambda c: F.xxhash64(F.col(c).cast("string"))
        left, r = left.withColumn("_key_hash", hashed(left_key)), r.withColumn("_anti_hash", hashed("_anti_key"))
        return left.join(r, on=match & (F.col("_key_hash") == F.col("_anti_hash")), how="left_anti").drop("_key_hash")
    return left.join(r, on=match, how="left_anti")
