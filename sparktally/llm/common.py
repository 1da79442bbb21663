"""Helpers shared by the operators of this subpackage.

Scratch tables live in the folder of ``spark.checkpoint.dir`` (shared by the
driver and all executors on a cluster), so a lost executor loses no
intermediate result and lineage is cut at every written table.
"""

from __future__ import annotations

import gc
import pickle
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.session import delete_at_exit, delete_path, scratch_path

_U64 = np.uint64


# Remove a query's shuffle files when it ends: what it wrote is read from the
# written table from then on.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back.
    The table is deleted when the driver ends, if not before."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    delete_at_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop_scratch(*frames: DataFrame) -> None:
    """Delete the files of materialised tables that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_scratch_path", None)
        if path:
            delete_path(df.sparkSession, path)


def ship(spark: SparkSession, value) -> Broadcast:
    """Broadcast ``value``, objects of this package's classes included, to
    tasks that need not have the package. Only for values of a fixed bound."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shipped(sent: Broadcast):
    """The value of ``ship``, inside a task."""
    return pickle.loads(sent.value)


@contextmanager
def no_collection() -> Iterator[None]:
    """For tasks with large caches without cycles, which the collector need
    not search. The worker goes on to other tasks, so it is turned on again."""
    collecting = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if collecting:
            gc.enable()


def crc_mod(col: str, modulus: int) -> Column:
    """crc32 of a column's text, modulo ``modulus`` (NULL: of the empty text)."""
    text = F.coalesce(F.col(col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply), element-wise."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def to_i64(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_array(values: np.ndarray, lengths: Sequence[int], kind=pa.int64()) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def small_batches(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the incoming batches holding about ``max_bytes`` of ``column``
    (one row at least), so that working memory follows a constant and the
    longest text, not the Arrow batch size."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        if n == 1 or col.nbytes <= max_bytes:
            yield batch
            continue
        step = max(1, n * max_bytes // col.nbytes)
        for a in range(0, n, step):
            yield batch.slice(a, step)


def grouped(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """Consecutive rows with equal ``key`` of a key-sorted stream of batches."""
    held: list[pa.RecordBatch] = []
    current: object = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = np.asarray(batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False))
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        bounds = [0, *cuts.tolist(), len(keys)]
        for a, b in zip(bounds[:-1], bounds[1:]):
            k = keys[a]
            if held and k != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = k
            held.append(batch.slice(a, b - a))
    if held:
        yield current, pa.Table.from_batches(held)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges`` (two long columns).

    Contraction rounds: every node hooks to the neighbour of lowest hashed
    order if that is lower than its own, edges are rewritten to the hooked
    nodes, and the loop ends when no edge joins two different nodes. The
    hashed order makes the rounds logarithmic whatever the ids look like. The
    minima are partial aggregates and every join is against a written table
    with one row per node, so a hub node can be split by adaptive skew
    handling. Roots are arbitrary members; take the minimum of what you need
    per root. NULL ends are ignored; an edge of a node with itself gives the
    node alone.
    """
    cur = materialize(
        edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "cc-edges",
    )
    nodes = cur.select(F.col("a").alias("node")).union(cur.select("b")).distinct()
    assign = materialize(nodes.select("node", F.col("node").alias("root")), "cc-assign")
    cur_live = cur.where("a != b")
    while not cur_live.isEmpty():
        order = lambda c: F.struct(F.xxhash64(F.col(c)).alias("h"), F.col(c).alias("v"))
        both = cur_live.select(F.col("a").alias("x"), F.col("b").alias("y")).union(cur_live.select("b", "a"))
        hook = (
            both.groupBy("x").agg(F.min(order("y")).alias("m"))
            .where(F.col("m") < order("x"))
            .select("x", F.col("m.v").alias("p"))
        )
        hook = materialize(hook, "cc-hook")
        ha = hook.select(F.col("x").alias("a"), F.col("p").alias("pa"))
        hb = hook.select(F.col("x").alias("b"), F.col("p").alias("pb"))
        nxt = materialize(
            cur_live.join(ha, "a", "left")
            .join(hb, "b", "left")
            .select(F.coalesce("pa", "a").alias("u"), F.coalesce("pb", "b").alias("v"))
            .where("u != v")
            .select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))
            .distinct(),
            "cc-edges",
        )
        moved = materialize(
            assign.join(hook.withColumnRenamed("x", "root"), "root", "left")
            .select("node", F.coalesce("p", "root").alias("root")),
            "cc-assign",
        )
        drop_scratch(cur, assign, hook)
        cur, cur_live, assign = nxt, nxt, moved
    drop_scratch(cur)
    return assign


def partitions_for(spark: SparkSession, least: int = 1) -> int:
    """The session's shuffle partition count."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
