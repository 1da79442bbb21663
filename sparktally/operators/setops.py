"""Bag union of several inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name: duplicates kept, no shuffle (the result has
    the partitions of all inputs)."""
    if not frames:
        raise ValueError("union_all needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b), frames)
