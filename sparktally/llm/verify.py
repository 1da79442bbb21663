"""Exact verification of similar sets inside coarse clusters.

A coarse cluster (items chained by banding collisions) may be of any size,
so it is dealt out in blocks: its items are hashed into chunks of bounded
bytes and every unordered pair of chunks is one group, which a single task
compares. All pairs of items of a cluster meet in exactly one kind of group;
only confirmed links that join two still separate parts of the group are
returned, so the output stays below the number of items per group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktally.llm.shingles import similar

CHUNK_BYTES = 6 << 20


def chunk_counts(members: DataFrame, cluster: str, weight: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(cluster, chunks): how many chunks of about ``chunk_bytes`` a cluster needs."""
    return members.groupBy(cluster).agg(
        F.ceil(F.sum(F.col(weight).cast("double")) / chunk_bytes).cast("int").alias("chunks")
    )


def confirmed_links(items: DataFrame, percent: int, max_flips: int | None = None) -> DataFrame:
    """(a, b) links between items of equal cluster.

    ``items``: cluster long, item long, chunks int, members array<long>
    (sorted, without repeats) and, with ``max_flips``, sketch binary. Pairs
    whose sketches differ in more bits are skipped (without sketches: pairs
    that the prefix filter excludes); all others are compared on their full
    sets unless already connected in the group.
    """
    keyed = (
        items.withColumn("chunk", F.pmod(F.xxhash64("item"), F.greatest(F.lit(1), "chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), "chunks") - 1)))
        .withColumn("group", F.xxhash64("cluster", F.least("chunk", "other"), F.greatest("chunk", "other")))
        .withColumn("cross", F.col("chunk") != F.col("other"))
        .select("group", "cross", "chunk", "item", "members", *(["sketch"] if max_flips is not None else []))
    )
    # A group (i, j) holds all of chunk i and of chunk j; (i, i) is the only
    # one in which rows of one chunk are compared with each other.

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last, still open group
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            group = table.column("group").to_numpy()
            if not len(group):
                continue
            cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist()]
            held = table.slice(cuts[-1])
            yield from _links(table.slice(0, cuts[-1]), cuts)
        if held is not None:
            yield from _links(held, [0, held.num_rows])

    def _links(table: pa.Table, cuts: list[int]) -> Iterator[pa.RecordBatch]:
        links = _compare_groups(table, cuts, percent, max_flips)
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return keyed.repartition("group").sortWithinPartitions("group").mapInArrow(run, "a long, b long")


def _compare_groups(table: pa.Table, cuts: list[int], percent: int, max_flips: int | None) -> list[tuple[int, int]]:
    """Links of every group of rows [cuts[i], cuts[i + 1])."""
    if len(cuts) < 2 or not table.num_rows:
        return []
    item = table.column("item").to_numpy()
    cross = table.column("cross").to_numpy()
    side = table.column("chunk").to_numpy()
    members = pa.concat_arrays(table.column("members").chunks)
    offsets, values = members.offsets.to_numpy(), members.values.to_numpy()
    bits = None
    if max_flips is not None:
        bits = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint64).reshape(len(item), -1)
    links: list[tuple[int, int]] = []
    for a, b in zip(cuts, cuts[1:]):
        if b - a == 2:
            x, y = values[offsets[a] : offsets[a + 1]], values[offsets[a + 1] : offsets[b]]
            if bits is not None and int(np.bitwise_count(bits[a] ^ bits[a + 1]).sum()) > max_flips:
                continue
            if not (cross[a] and side[a] == side[a + 1]) and similar(x, y, percent):
                links.append((int(item[a]), int(item[a + 1])))
        elif b - a > 2:
            sets = [values[offsets[i] : offsets[i + 1]] for i in range(a, b)]
            found = _compare(sets, side[a:b] if cross[a] else None, None if bits is None else bits[a:b], percent, max_flips)
            links += [(int(item[a + i]), int(item[a + j])) for i, j in found]
    return links


def _compare(
    sets: list[np.ndarray], side: np.ndarray | None, bits: np.ndarray | None, percent: int, max_flips: int | None
) -> list[tuple[int, int]]:
    """Confirmed links of one group that join separate parts of it; with
    ``side`` only between rows of different chunks."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    if bits is None:
        # Prefix filter: two sets this similar share one of their smallest
        # elements, as many as they may differ in and one more. The holders of
        # an element are kept by connected part, so parts that an item is
        # already in are passed over whole.
        holders: dict[int, dict[int, list[int]]] = {}
        for i, members in enumerate(sets):
            tried: set[int] = set()
            for h in members[: len(members) - -(-percent * len(members) // 100) + 1].tolist():
                known = holders.setdefault(h, {})
                for root in [r for r in known if parent[r] != r]:
                    known.setdefault(find(root), []).extend(known.pop(root))
                for root, part in known.items():
                    if find(root) == find(i):
                        continue
                    for j in part:
                        if j in tried or side is not None and side[i] == side[j]:
                            continue
                        tried.add(j)
                        if similar(sets[j], members, percent):
                            a, b = find(i), find(j)
                            parent[max(a, b)] = min(a, b)
                            links.append((j, i))
                            break
                known.setdefault(find(i), []).append(i)
        return links
    for i in range(n - 1):
        later = sizes[i + 1 :]
        ok = 100 * np.minimum(later, sizes[i]) >= percent * np.maximum(later, sizes[i])
        if side is not None:
            ok &= side[i + 1 :] != side[i]
        order = np.flatnonzero(ok)
        if len(order):
            flips = np.bitwise_count(bits[i + 1 + order] ^ bits[i]).sum(axis=1)
            order = order[np.argsort(flips, kind="stable")][: int((flips <= max_flips).sum())]
        for j in (order + i + 1).tolist():
            a, b = find(i), find(j)
            if a != b and similar(sets[i], sets[j], percent):
                parent[max(a, b)] = min(a, b)
                links.append((i, j))
    return links
