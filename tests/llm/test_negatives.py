"""Hard negatives against full computation; the shared list's certificate."""

import random

import numpy as np
import pytest

from sparktally.llm import negatives


def _brute(rows, anchors, positives=5, negs=10, low=30, high=90):
    out = []
    for a in anchors:
        label, u = rows[a]
        score = {i: sum(x * y for x, y in zip(u, v)) for i, (_, v) in rows.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if rows[i][0] == label][:positives]:
            fit = [i for i in order if rows[i][0] != label and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, r, i, score[p], score[i]) for r, i in enumerate(fit[:negs], 1)]
    return sorted(out)


def _rows(seed, n=260, dims=8, labels=4, spread=20):
    rng = random.Random(seed)
    return {i: (rng.randrange(labels), [rng.randint(-spread, spread) for _ in range(dims)]) for i in range(n)}


SCHEMA = "vec_id long, label int, vector array<long>, score string, q int"


def _frame(spark, rows, more=()):
    data = [(i, lab, v, "clash", 1) for i, (lab, v) in rows.items()]
    return spark.createDataFrame(data + list(more), SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_full_computation_over_many_blocks(spark, monkeypatch, seed):
    monkeypatch.setattr(negatives, "ROWS", 50)
    monkeypatch.setattr(negatives, "ANCHORS", 9)
    monkeypatch.setattr(negatives, "STEP", 8)
    monkeypatch.setattr(negatives, "MEMBERS", 3)
    rows = _rows(seed)
    # Ties, copies of an anchor under other labels, zero and short vectors, a label of its own, a hot label.
    rows |= {300 + i: (0, rows[10][1]) for i in range(30)} | {340 + i: (1, rows[10][1]) for i in range(12)}
    rows |= {400: (2, [0] * 8), 410: (2, [0] * 8), 401: (3, [5]), 420: (3, []), 430: (9, [1] * 8)}
    bad = [(None, 1, [1] * 8, "", 0), (990, None, [1] * 8, "", 0), (980, 1, None, "", 0), (970, 1, [1, None], "", 0)]
    df = _frame(spark, rows, bad + [(i, lab, v, "again", 2) for i, (lab, v) in list(rows.items())[:40]])
    got = negatives.mine(df, negatives.F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == _brute(rows, [i for i in rows if i % 10 == 0])


def test_repeated_ids_with_other_contents_count_once(spark):
    rows = {0: (1, [2, 0]), 1: (1, [3, 0]), 2: (2, [2, 1])}
    df = _frame(spark, rows, [(2, 2, [9, 9], "", 0), (1, 5, [3, 0], "", 0)])
    got = negatives.mine(df, negatives.F.col("vec_id") == 0).collect()
    assert sorted(map(tuple, got)) == _brute(rows, [0])


def test_empty_table_single_label_and_no_anchor(spark):
    rows = _rows(3, n=20, labels=1)
    df = _frame(spark, rows)
    assert negatives.mine(df.limit(0), negatives.F.col("vec_id") == 0).collect() == []
    assert negatives.mine(df, negatives.F.col("vec_id") == 0).collect() == []
    assert negatives.mine(df, negatives.F.col("vec_id") == -1).collect() == []


def test_embeddings_rule(spark):
    rng = np.random.default_rng(5)
    table = [(i, rng.normal(size=6).astype(np.float32).tolist(), int(rng.integers(0, 10))) for i in range(320)]
    bad = [(700, [float("nan")] * 6, 1), (800, None, 1), (900, [0.5] * 6, None), (1000, [float("inf")] + [0.0] * 5, 2)]
    df = spark.createDataFrame(table + bad, "vec_id long, embedding array<float>, label int")
    rows = {
        i: ((lab + 1) % 10 if i % 7 == 0 else lab, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]) for i, v, lab in table
    }
    got = sorted(map(tuple, negatives.mine_embeddings(df).collect()))
    assert got == _brute(rows, [i for i in rows if i % 100 == 0])


def test_bounds_hold_for_every_member():
    rng = np.random.default_rng(6)
    for members, rows in [
        (rng.normal(size=(7, 5)), rng.normal(size=(200, 5)) * 9),
        (np.ones((3, 5)), np.vstack([np.ones((2, 5)), -np.ones((2, 5)), np.zeros((1, 5))])),
        (np.vstack([np.ones((1, 5)), -np.ones((1, 5)), np.zeros((1, 5))]), rng.normal(size=(50, 5))),
    ]:
        bounds = negatives.angular_bounds(members, rows)
        assert (members @ rows.T <= np.linalg.norm(members, axis=1)[:, None] * bounds + 1e-7).all()


def test_walks_end_early_and_every_anchor_is_in_one_cluster():
    """Tight clusters and a long tail of far candidates: most is never scored."""
    rng = np.random.default_rng(7)
    anchors = np.rint(100 + rng.normal(size=(64, 16)) * 5).astype(np.int64)
    near, far = 100 + rng.normal(size=(300, 16)) * 5, rng.normal(size=(8000, 16)) * 40
    rows = np.rint(np.vstack([near, far])).astype(np.int64)
    assert sorted(np.concatenate(negatives.clusters(anchors.astype(float)))) == list(range(64))
    least = np.iinfo(np.int64)
    asked = negatives.Asked(np.arange(64), np.full(64, least.min), np.full(64, least.max))
    best, scored = negatives.walk(anchors, rows, asked, 5, lambda a, at: np.ones((len(a), len(at)), dtype=bool))
    assert scored < 64 * len(rows) / 4
    scores = anchors @ rows.T
    for q in range(64):
        order = np.lexsort((np.arange(len(rows)), -scores[q]))[:5]
        assert best[q].tolist() == [int(scores[q, i]) * len(rows) + len(rows) - 1 - int(i) for i in order]


def test_scores_that_cannot_be_ranked_are_refused():
    big = np.full((1, 2), 2**40, dtype=np.int64)
    asked = negatives.Asked(np.array([0]), np.array([0]), np.array([1]))
    with pytest.raises(ValueError, match="49 bits"):
        negatives.walk(big, big, asked, 1, None)
