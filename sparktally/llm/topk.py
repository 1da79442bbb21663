"""Exact top-k inner-product search by term-at-a-time accumulation.

Vectors are sparse rows of integer weights. A task holds one block of
candidates as postings (per dimension: which rows have a weight, and the
weights) and one block of queries. For every dimension the queries that have
it scatter their weight times the postings into a dense query x candidate
score array; a partition selection keeps each query's best k of the block,
and a window over the query merges the blocks.

Queries and candidates meet block by block: every candidate block is sent to
every query block, so the work is the product a full search needs while no
task holds more than one block of each and nothing is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktally.llm.common import grouped

CANDIDATES, QUERIES = 8192, 1024  # most rows of a block
BLOCK_CELLS = 1 << 21  # most components of a block of candidates
SCORES = 1 << 17  # cells of a score array, which stays in the cache
SCALE = 64


def valid_vector(vector: Column) -> Column:
    """Not NULL, without NULL, NaN or infinite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


class Postings:
    """Rows and weights of each dimension of a block of candidates."""

    def __init__(self, matrix: np.ndarray):
        self.rows = len(matrix)
        self.lists = []
        for column in np.ascontiguousarray(matrix.T):
            at = np.flatnonzero(column)
            # A list of most rows is scattered as one run, its zeros included.
            full = 2 * len(at) >= self.rows
            self.lists.append((slice(None), column) if full else (at, column[at]))

    def accumulate(self, queries: np.ndarray, dtype) -> np.ndarray:
        """Scores of every query against every row, one term at a time: a
        term's weighted postings go to all queries that have it at once."""
        scores = np.zeros((len(queries), self.rows), dtype=dtype)
        for weights, (at, values) in zip(np.ascontiguousarray(queries.T).astype(dtype), self.lists):
            have = np.flatnonzero(weights)
            if not len(have) or not len(values):
                continue
            if 2 * len(have) >= len(queries):
                have = slice(None)
            weighted = np.multiply.outer(weights[have], values.astype(dtype))
            if isinstance(have, slice) or isinstance(at, slice):
                scores[have, at] += weighted
            else:
                scores[np.ix_(have, at)] += weighted
        return scores


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller place."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= floor)
    else:
        places = np.arange(len(scores))
    return places[np.argsort(-scores[places], kind="stable")][:k]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows padded with zeros to ``width`` dimensions."""
    array = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    offsets = array.offsets.to_numpy()
    values = array.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    out = np.zeros((len(array), width), dtype=np.int64)
    if len(sizes) and (sizes == width).all():
        out[:] = values[offsets[0] : offsets[-1]].reshape(-1, width)
    else:
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            out[i, : b - a] = values[a:b]
    return out


def _width(column: pa.ChunkedArray) -> int:
    return max((int(np.diff(c.offsets.to_numpy()).max(initial=0)) for c in column.chunks), default=0)


def _search(table: pa.Table, k: int) -> Iterator[pa.RecordBatch]:
    is_query = table.column("is_query").to_numpy()
    width = _width(table.column("vector"))
    matrix = _matrix(table.column("vector"), width)
    ids = table.column("vec_id").to_numpy()
    queries, query_ids = matrix[is_query], ids[is_query]
    rows, row_ids = matrix[~is_query], ids[~is_query]
    if not len(queries) or not len(rows):
        return
    order = np.argsort(row_ids, kind="stable")
    rows, row_ids = rows[order], row_ids[order]
    # The narrow type only where no sum can leave it.
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, width)
    dtype = np.int32 if bound < 2**31 else np.int64
    postings = Postings(rows)
    step = max(1, SCORES // len(rows))
    for a in range(0, len(queries), step):
        scores = postings.accumulate(queries[a : a + step], dtype)
        out: list[list[np.ndarray]] = [[], [], []]
        for q, found in zip(query_ids[a : a + step], scores):
            own = np.flatnonzero(row_ids == q) if q in (row_ids[np.searchsorted(row_ids, q) % len(row_ids)],) else []
            best = best_of(found, k + len(own))
            best = best[row_ids[best] != q][:k]
            out[0].append(np.full(len(best), q))
            out[1].append(row_ids[best])
            out[2].append(found[best].astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c), pa.int64()) for c in out], names=["query_id", "vec_id", "score"]
        )


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "vector") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer
    inner products with the rows of other vec_ids, ties to the smaller vec_id.

    ``vector`` is an array<long>; missing dimensions count as 0. NULL vectors,
    vectors with NULL components and NULL ids take no part. Repeated rows of a
    vec_id are separate candidates; a repeated query is answered once, by its
    smallest vector. An empty side gives an empty result. Sums outside 64 bits wrap around. Other
    columns are ignored, whatever their names.
    """
    slim = lambda df: df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).where(
        "vec_id IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)"
    )
    rows, asked = slim(vectors), slim(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    shape = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).first()
    per_block = max(1, min(CANDIDATES, BLOCK_CELLS // max(1, shape["width"])))
    row_blocks = -(-max(1, shape["n"]) // per_block)
    asked_blocks = -(-max(1, asked.count()) // min(QUERIES, per_block))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sent = rows.select("*", F.lit(False).alias("is_query"), block(row_blocks).alias("r")).withColumn("q", every(asked_blocks))
    put = asked.select("*", F.lit(True).alias("is_query"), block(asked_blocks).alias("q")).withColumn("r", every(row_blocks))
    pairs = sent.unionByName(put).select("vec_id", "vector", "is_query", (F.col("q") * F.lit(row_blocks) + F.col("r")).alias("pair"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in grouped(batches, "pair"):
            yield from _search(table, k)

    found = (
        pairs.repartition(row_blocks * asked_blocks, "pair").sortWithinPartitions("pair")
        .mapInArrow(run, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_embeddings(embeddings: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """Top ``k`` of the rows whose vec_id is divisible by ``every`` against all
    other rows, on floor(64 x) of every component."""
    vectors = embeddings.where(valid_vector(F.col("embedding"))).select("vec_id", scaled(F.col("embedding")).alias("vector"))
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k)


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
