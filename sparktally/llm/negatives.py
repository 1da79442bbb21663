"""Hard-negative mining with shared lists of anchor clusters (as MAXIMUS does).

Every anchor needs the best rows of its own label (positives) and, for each
positive, the best rows of other labels whose score lies in a window below
the positive's (negatives). Both are walks down one list: a task holds one
block of anchors and one block of candidates, clusters the anchors by
direction, and for each cluster sorts the candidates once by an angular upper
bound of their score. With t the largest angle between a member and the
cluster's centre and a the angle between a candidate c and the centre, no
member can have a smaller angle with c than a - t, so

    u . c <= |u| * |c| * cos(max(0, a - t))

and |c| * cos(max(0, a - t)) is an order that all members share. Every member
walks the list from the top and stops once the bound of what is left is below
its k-th best score (or below the lowest score its window admits): nothing
further down can change its result. The results of the blocks are merged by a
window over the anchor.

Anchors and candidates meet block by block, by an equi-join in effect: each
candidate is sent once to every block of anchors it can serve, so no task
holds more than a block of each and nothing is broadcast. Positives are
searched label by label, with blocks of their own for every label, so a label
of a third of all rows is many blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktally.llm.common import materialize
from sparktally.llm.topk import scaled, valid_vector

ROWS, ANCHORS = 8192, 1024  # most rows of a block
BLOCK_CELLS = 1 << 21  # most components of a block of candidates
MEMBERS = 32  # anchors of a cluster, about
STEP = 512  # candidates scored between two checks for the end of a walk
EXACT = 1 << 49  # scores below this leave room for a row's place in 63 bits
NONE = np.iinfo(np.int64).min


def clusters(vectors: np.ndarray, size: int = MEMBERS, rounds: int = 4) -> list[np.ndarray]:
    """Places of the vectors, in groups of similar direction: centres are
    spread by farthest-first choice and moved by a few rounds of spherical
    k-means. Any grouping gives the same results; a tight one ends walks
    sooner."""
    norms = np.linalg.norm(vectors, axis=1)
    unit = vectors / np.where(norms > 0, norms, 1.0)[:, None]
    k = -(-len(vectors) // size)
    centres = [unit[0]]
    nearest = unit @ centres[0]
    for _ in range(1, k):
        centres.append(unit[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, unit @ centres[-1])
    middle = np.array(centres)
    for _ in range(rounds):
        of = np.argmax(unit @ middle.T, axis=1)
        sums = np.zeros_like(middle)
        np.add.at(sums, of, unit)
        length = np.linalg.norm(sums, axis=1)
        middle = np.where(length[:, None] > 0, sums / np.where(length > 0, length, 1.0)[:, None], middle)
    of = np.argmax(unit @ middle.T, axis=1)
    return [np.flatnonzero(of == c) for c in np.unique(of)]


def angular_bounds(members: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Per row a number b with u . row <= |u| * b for every member u; rounding
    errors are on the safe side."""
    norms = np.linalg.norm(members, axis=1)
    unit = members[norms > 0] / norms[norms > 0][:, None]
    length = np.linalg.norm(rows, axis=1)
    centre = unit.sum(axis=0)
    span = np.linalg.norm(centre)
    if span == 0:
        return length * (1 + 1e-9)
    centre /= span
    angle = lambda cosine: np.arccos(np.clip(cosine, -1.0, 1.0))
    widest = angle(unit @ centre).max()
    apart = angle((rows @ centre) / np.where(length > 0, length, 1.0))
    # arccos is off by up to about 2e-8 near 0 and pi.
    return length * (np.cos(np.maximum(0.0, apart - widest - 1e-6)) + 1e-9)


def _bound_of_scores(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])


class Asked:
    """What the walks look for: per line the place of its anchor and the
    lowest and highest score admitted."""

    def __init__(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.anchor, self.low, self.high = anchor, low, high


def walk(anchors: np.ndarray, rows: np.ndarray, asked: Asked, k: int, admitted) -> tuple[np.ndarray, int]:
    """Keys of the ``k`` best rows of every line of ``asked``, best first, and
    the number of scores computed. A key is score * len(rows) plus how many
    rows come after this one, so higher keys are higher scores, ties to the
    earlier row; NONE fills missing places. ``admitted(anchor places, row
    places)``: which pairs count at all."""
    if _bound_of_scores(anchors, rows) * max(1, len(rows)) >= EXACT * 8192.0:
        raise ValueError("scores beyond 49 bits cannot be ranked exactly: use smaller weights")
    n = len(rows)
    u, c = anchors.astype(np.float64), rows.astype(np.float64)
    best = np.full((len(asked.anchor), k), NONE, dtype=np.int64)
    length = np.linalg.norm(u, axis=1)
    scored = 0
    wanted = np.unique(asked.anchor)
    for group in clusters(u[wanted]) if len(wanted) else []:
        members = wanted[group]
        bounds = angular_bounds(u[members], c)
        order = np.argsort(-bounds, kind="stable")
        lines = np.flatnonzero(np.isin(asked.anchor, members))
        for start in range(0, n, STEP):
            # The most a line's anchor can still score; its k-th best so far.
            reach = length[asked.anchor[lines]] * bounds[order[start]]
            reach = reach + 1e-9 * np.abs(reach)
            worst = best[lines, -1]
            kth = np.where(worst == NONE, -np.inf, worst // n)
            lines = lines[(kth <= reach) & (asked.low[lines] <= reach)]
            if not len(lines):
                break
            at = order[start : start + STEP]
            walking, line_of = np.unique(asked.anchor[lines], return_inverse=True)
            # Whole numbers below 2^53: the product of doubles is exact.
            scores = (u[walking] @ c[at].T).astype(np.int64)
            scored += scores.size
            keys = np.where(admitted(walking, at), scores * n + (n - 1 - at), NONE)[line_of]
            of_line = scores[line_of]
            keys[(of_line < asked.low[lines, None]) | (of_line > asked.high[lines, None])] = NONE
            both = np.concatenate([best[lines], keys], axis=1)
            best[lines] = -np.sort(-np.partition(both, both.shape[1] - k, axis=1)[:, -k:], axis=1)
    return best, scored


def _split(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Anchors and candidates of a task, candidates in ascending order of id."""
    is_anchor = table.column("is_anchor")
    anchors = table.filter(is_anchor)
    return anchors, table.filter(pc.invert(is_anchor)).sort_by("vec_id")


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    out = np.zeros((table.num_rows, width), dtype=np.int64)
    for row, values in enumerate(table.column("vector")):
        found = values.values.to_numpy()
        out[row, : len(found)] = found
    return out


def _vectors(anchors: pa.Table, rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    width = max((len(v) for t in (anchors, rows) for v in t.column("vector")), default=0)
    return _matrix(anchors, width), _matrix(rows, width)


def _read(best: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, id, score) of the places found."""
    line, place = np.nonzero(best != NONE)
    keys = best[line, place]
    score, after = np.divmod(keys, len(ids))
    return line, ids[len(ids) - 1 - after], score


def _meet(rows: DataFrame, anchors: DataFrame, keys: list[str], run, schema: str, tasks: int) -> DataFrame:
    """``run`` over the anchors and candidates of each key."""
    both = rows.withColumn("is_anchor", F.lit(False)).unionByName(anchors.withColumn("is_anchor", F.lit(True)), allowMissingColumns=True)
    return both.repartition(tasks, *keys).groupBy(*keys).applyInArrow(run, schema)


def _part(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("vec_id"), blocks)


def _every(blocks: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))


def _blocks(count: str, most: int) -> Column:
    return F.ceil(F.col(count) / F.lit(most)).cast("long")


def _best(found: DataFrame, per: list[str], score: str, other: str, k: int) -> DataFrame:
    order = Window.partitionBy(*per).orderBy(F.desc(score), other)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_positives(rows: DataFrame, anchors: DataFrame, k: int, per_block: int) -> DataFrame:
    """anchor_id, positive_id, positive_score: the ``k`` best other rows of
    each anchor's label."""
    sizes = materialize(
        anchors.groupBy("label").agg(F.count("*").alias("asked"))
        .join(rows.groupBy("label").agg(F.count("*").alias("held")), "label"),
        "negatives-labels",
    )
    blocks_q, blocks_r = _blocks("asked", min(ANCHORS, per_block)), _blocks("held", per_block)
    tasks = sizes.agg(F.sum(blocks_q * blocks_r)).first()[0] or 1
    columns = ["vec_id", "label", "vector", "q", "r"]
    sent = rows.join(sizes, "label").withColumn("r", _part(blocks_r)).withColumn("q", _every(blocks_q)).select(*columns)
    put = anchors.join(sizes, "label").withColumn("q", _part(blocks_q)).withColumn("r", _every(blocks_r)).select(*columns)

    def run(table: pa.Table) -> pa.Table:
        asking, held = _split(table)
        u, c = _vectors(asking, held)
        own, ids = asking.column("vec_id").to_numpy(), held.column("vec_id").to_numpy()
        every = np.arange(len(own))
        limits = np.iinfo(np.int64)
        asked = Asked(every, np.full(len(own), limits.min), np.full(len(own), limits.max))
        best, _ = walk(u, c, asked, k, lambda a, at: own[a, None] != ids[None, at])
        line, found, score = _read(best, ids)
        return pa.table({"anchor_id": own[line], "positive_id": found, "positive_score": score})

    schema = "anchor_id long, positive_id long, positive_score long"
    found = _meet(sent, put, ["label", "q", "r"], run, schema, _tasks(rows, tasks))
    return _best(found, ["anchor_id"], "positive_score", "positive_id", k).drop("rank")


def _tasks(rows: DataFrame, groups: int) -> int:
    """Partitions for a number of groups: one each, up to a few waves."""
    spark = rows.sparkSession
    return max(1, min(groups, 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))))


def best_negatives(rows: DataFrame, anchors: DataFrame, positives: DataFrame, k: int, low: int, high: int, per_block: int) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: for every pair of anchor and positive the ``k`` best rows
    of other labels within the window below the positive's score."""
    # No score satisfies low * p <= 100 * s <= high * p for a negative p.
    wanted = positives.where("positive_score >= 0").groupBy("anchor_id").agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")  # at most the number of positives
    )
    asking = materialize(anchors.join(wanted, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"), "negatives-anchors")
    n, m = rows.count(), asking.count()
    row_blocks = -(-max(1, n) // per_block)
    asked_blocks = -(-max(1, m) // min(ANCHORS, per_block))
    columns = ["vec_id", "label", "vector", "q", "r"]
    sent = rows.withColumn("r", _part(F.lit(row_blocks))).withColumn("q", _every(F.lit(asked_blocks))).select(*columns)
    put = asking.withColumn("q", _part(F.lit(asked_blocks))).withColumn("r", _every(F.lit(row_blocks))).select(*columns, "positives")

    def run(table: pa.Table) -> pa.Table:
        asking, held = _split(table)
        u, c = _vectors(asking, held)
        own, ids = asking.column("vec_id").to_numpy(), held.column("vec_id").to_numpy()
        label, labels = asking.column("label").to_numpy(), held.column("label").to_numpy()
        pairs = [(i, p["positive_id"], p["positive_score"]) for i, ps in enumerate(asking.column("positives").to_pylist()) for p in ps]
        anchor, positive, score = (np.array([p[f] for p in pairs], dtype=np.int64) for f in range(3))
        asked = Asked(anchor, -(-low * score // 100), high * score // 100)
        best, _ = walk(u, c, asked, k, lambda a, at: (label[a, None] != labels[None, at]) & (own[a, None] != ids[None, at]))
        line, found, negative = _read(best, ids)
        return pa.table(
            {
                "anchor_id": own[anchor[line]], "positive_id": positive[line], "negative_id": found,
                "positive_score": score[line], "negative_score": negative,
            }
        )

    schema = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    found = _meet(sent, put, ["q", "r"], run, schema, _tasks(rows, row_blocks * asked_blocks))
    return _best(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", k).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score.

    ``vectors``: vec_id (long), label, vector (array<long>; missing dimensions
    count as 0). ``is_anchor`` chooses the anchors. An anchor's positives are
    its ``positives`` best other rows of the same label; the negatives of a
    positive with score p are the ``negatives`` best rows of another label
    with low * p <= 100 * score <= high * p. Higher inner products come first,
    ties go to the smaller vec_id; fewer rows are returned where there are
    fewer. Rows with a NULL vec_id, label, vector or component take no part.
    Of repeated rows of one vec_id the smallest (label, vector) counts. Rows
    whose scores could need 49 bits or more are refused with an error. Other
    columns are ignored, whatever their names; an empty table gives none.
    """
    rows = materialize(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "vector", is_anchor.alias("anchor"))
        .where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")
        .groupBy("vec_id").agg(F.min(F.struct("label", "vector", "anchor")).alias("v"))
        .select("vec_id", "v.label", "v.vector", "v.anchor"),
        "negatives-rows",
    )
    anchors = rows.where("anchor").drop("anchor")
    rows = rows.drop("anchor")
    width = rows.agg(F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).first()["width"]
    per_block = max(1, min(ROWS, BLOCK_CELLS // max(1, width)))
    found = materialize(best_positives(rows, anchors, positives, per_block), "negatives-positives")
    return best_negatives(rows, anchors, found, negatives, low, high, per_block)


def mine_embeddings(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by 100, on
    floor(256 x) of every component. Where the vec_id is divisible by 7 the
    label is moved on by one (modulo 10), which gives every anchor strong rows
    of a wrong label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = embeddings.where(valid_vector(F.col("embedding")) & F.col("label").isNotNull()).select(
        "vec_id", moved.alias("label"), scaled(F.col("embedding"), 256).alias("vector")
    )
    return mine(vectors, F.col("vec_id") % 100 == 0)


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same
), n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
  WHERE p.place <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
