"""Counting, thresholds and top-k.

All counts are ``count(column)``: rows whose counted column is NULL are not
counted, yet their group is still emitted (with 0). Every ordering ends in
the grouping key so that ties always come out the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktally.functions.values import as_col


def count_by(
    df: DataFrame,
    keys: Sequence[Column | str],
    counted: Column | str,
    where: Column | None = None,
    name: str = "n",
) -> DataFrame:
    """Rows per group (NULLs of ``counted`` skipped). Keys may be
    expressions such as ``lower(category)``; alias them to name the output.
    Partial aggregation runs before the shuffle, so a hot key costs one row
    per map task."""
    src = df if where is None else df.where(where)
    return src.groupBy(*[as_col(k) for k in keys]).agg(F.count(as_col(counted)).alias(name))


def frequent(counts: DataFrame, count_col: str, min_exclusive: int, key: str) -> DataFrame:
    """Groups counted more than ``min_exclusive`` times, most frequent
    first, ties by key."""
    return counts.where(F.col(count_col) > min_exclusive).orderBy(F.desc(count_col), F.asc(key))


def top_k(
    df: DataFrame,
    k: int,
    order: Sequence[Column],
    per: Sequence[str] | None = None,
    ordered: bool = True,
) -> DataFrame:
    """The first ``k`` rows by ``order``, overall or within each group of
    ``per``. ``order`` must end in a unique key for a deterministic result.

    Overall: ``orderBy().limit()``, planned as ``TakeOrderedAndProject``
    (each task keeps its best k, no full sort). Per group: ``row_number()
    <= k``, planned with ``WindowGroupLimit`` on both sides of the exchange,
    so at most k rows per group and task cross the shuffle however large
    (or skewed) a group is. With ``ordered`` the result is sorted by group,
    then ``order`` (a report order; it costs a sort of k rows per group).
    """
    if not per:
        return df.orderBy(*order).limit(k)
    w = Window.partitionBy(*per).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    if ordered:
        ranked = ranked.orderBy(*[F.col(p) for p in per], F.col("_rank"))
    return ranked.drop("_rank")


def group_collect(
    df: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    name: str = "items",
    sort_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per group holding its rows as an array of structs (a bag).

    The array is sorted by ``sort_by`` fields (default: ``fields``), so the
    result does not depend on arrival order. Apply it to bounded groups
    only, e.g. after ``top_k`` per group: one group is one array in one
    task.
    """
    order = list(sort_by or fields)
    rest = [f for f in fields if f not in order]
    packed = F.struct(*[F.col(f) for f in order + rest])
    out = df.groupBy(*keys).agg(F.sort_array(F.collect_list(packed)).alias(name))
    return out.select(*keys, F.transform(F.col(name), lambda s: F.struct(*[s[f].alias(f) for f in fields])).alias(name))
