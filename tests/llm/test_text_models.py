"""Toxicity on held-out rows; LM scores against direct computation."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from sparktally.llm import lm, toxicity
from sparktally.llm.queries import QUERIES
from tests.conftest import SF_SMOKE

BAD = ["idiot", "moron", "scum", "trash"]


def _crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


def _corpus(n=400, seed=3):
    rng = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ne", "ru", "ta", "si", "do", "pe", "an"]
    vocab = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(vocab, k=rng.randint(20, 120))
        toxic = i % 4 == 0
        if toxic:
            for w in rng.choices(BAD, k=3):
                words[rng.randrange(len(words))] = w
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def _chains(n=500, seed=8):
    """Texts in which a word has four possible followers."""
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        at, words = rng.randrange(200), []
        for _ in range(rng.randint(20, 120)):
            at = (at * 7 + rng.randrange(4)) % 200
            words.append(f"w{at}")
        docs.append((i, " ".join(words)))
    return docs


@pytest.fixture(scope="module")
def frames(spark):
    docs, labels = _corpus()
    extra = [(1000, None), (1001, ""), (1002, "y0u are an 1d10t and a m.o.r.o.n"), (1003, "such s c u m here"),
             (1004, "plain words kalo mine"), (1005, "trrrrraaash " * 3), (1005, "trrrrraaash " * 3), (None, "an idiot"), (1006, "moron " * 50_000)]
    rows = [(i, t, 0.5, 1) for i, t in docs + extra]
    d = spark.createDataFrame(rows, "doc_id long, text string, score double, toxic int")
    known = spark.createDataFrame(labels + [(0, 0), (5, None), (None, 1), (99999, 1)], "doc_id long, toxic int")
    return d, known, dict(labels)


def test_toxicity_held_out_accuracy_and_edge_rows(frames):
    d, known, truth = frames
    rows = toxicity.score_documents(d, known).collect()
    assert len(rows) == d.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (_crc(r.doc_id) % 3 == 1)
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(t == p for t, p in held) / len(held) >= 0.98
    by = {r.doc_id: r.predicted for r in rows}
    assert [by[i] for i in (1000, 1001, 1002, 1003, 1004, 1005, None, 1006)] == [0, 0, 1, 1, 0, 1, 1, 1]


def test_toxicity_never_reads_held_out_labels(spark, frames):
    d, known, _ = frames
    flipped = known.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    a = sorted((str(r.doc_id), r.score) for r in toxicity.score_documents(d, known).collect())
    assert a == sorted((str(r.doc_id), r.score) for r in toxicity.score_documents(d, flipped).collect())


def test_toxicity_without_labels_or_rows(spark, frames):
    d, known, _ = frames
    none = toxicity.score_documents(d, known.limit(0)).collect()
    assert {r.predicted for r in none} == {0}
    assert toxicity.score_documents(d.limit(0), known).collect() == []


def test_restoring_spellings():
    counts = np.zeros(toxicity.CELLS)
    for cells in toxicity.char_cells(" ".join(BAD * 50 + ["kalo", "mine", "and"] * 50)):
        counts += np.bincount(cells, minlength=toxicity.CELLS)
    reader = toxicity.Reader(toxicity.CharModel(counts), str)
    assert "idiot" in reader.read("You 1d10t!!")
    assert "moron" in reader.read("m-o-r-o-n")
    assert "scum" in reader.read("s c u m") and "scum" in reader.read("a\ns c u m\n")
    assert "trash" in reader.read("trrraaash")
    assert {"idiot", "idiiot"} <= reader.read("idiiot") and "moron" in reader.read("mooron")
    assert "ass" in reader.read("a s s") and "ass" in reader.read("ass")
    assert "kalo" in reader.read("(kalo),")
    assert reader.read("   ") == set()


def test_viterbi_takes_the_cheapest_path():
    """Against all paths through the lattices of short tokens."""
    counts = np.zeros(toxicity.CELLS)
    for cells in toxicity.char_cells(" ".join(BAD * 20 + ["kalo", "mine", "ass", "too"] * 20)):
        counts += np.bincount(cells, minlength=toxicity.CELLS)
    model = toxicity.CharModel(counts)

    def cost(path):
        state, total = "  ", 0.0
        for written, price in path:
            total += price
            if written:
                total += model.cost(state + written)
                state = state[1] + written
        return total + model.cost(state + " ")

    rng = random.Random(7)
    for _ in range(300):
        token = "".join(rng.choices("idotmrna01!$.- ss", k=rng.randint(1, 6)))
        paths = list(itertools.product(*(toxicity.lattice_arcs(token, k) for k in range(len(token)))))
        best = min(map(cost, paths))
        written = {"".join(w for w, _ in p) for p in paths if cost(p) <= best + 1e-9}
        assert toxicity.restore(token, model) in written
    for _ in range(300):
        word = "".join(c * rng.choice([1, 1, 1, 2]) for c in rng.choices("idotmrnas", k=rng.randint(1, 7)))
        word = re.sub(r"(.)\1+", r"\1\1", word)
        paths = list(itertools.product(*(toxicity.lattice_arcs(word, k) for k in range(len(word)))))
        best = min(map(cost, paths))
        assert toxicity.undoubled(word, model) in {"".join(w for w, _ in p) for p in paths if cost(p) <= best + 1e-9}


def test_character_cells_agree_one_by_one():
    text = "Ab é漢😀 9z"
    codes = "  " + text + " "
    for size, cells in zip((1, 2, 3), toxicity.char_cells(text)):
        assert cells.tolist() == [toxicity._cell(codes[i - size + 1 : i + 1]) for i in range(2, len(codes))]


def test_lm_matches_direct_unigrams_and_beats_base(spark):
    docs = [(i, t.title() if i % 7 == 0 else t) for i, t in _chains()]
    docs += [(2000, None), (2001, ""), (2002, "never seen words"), (2003, "twice same"), (2003, "twice same"), (None, "no id")]
    rows = [(i, t, 3) for i, t in docs]
    got = lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string, block int")).collect()
    assert len(got) == len(docs)
    train = Counter()
    for i, t in docs:
        if _crc(i) % 10:
            train.update((t or "").encode().lower().split() + [b"\n"])
    n, v = sum(train.values()), len(train)
    want = []
    for i, t in docs:
        w = (t or "").encode().lower().split() + [b"\n"]
        base = sum(math.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        want.append((str(i), _crc(i) % 10 == 0, len(w), sum(train[x] > 0 for x in w), n, round(base, 6)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)


def test_lm_blocks_do_not_matter(spark, monkeypatch):
    docs, _ = _corpus(120, 5)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    one = sorted(map(tuple, lm.score_documents(df).collect()))
    monkeypatch.setattr(lm, "BLOCK_BYTES", 3000)
    many = sorted(map(tuple, lm.score_documents(df).collect()))
    assert [r[:5] for r in one] == [r[:5] for r in many]
    assert np.allclose([r[5:] for r in one], [r[5:] for r in many])


def test_lm_counts_every_gram_exactly(spark, monkeypatch):
    """Scores against direct computation, with n-grams whose two occurrences
    lie in different blocks and partitions, and many owners of keys."""
    monkeypatch.setattr(lm, "BLOCK_BYTES", 500)
    monkeypatch.setattr(lm, "PART_KEYS", 400)
    rng = random.Random(11)
    docs = _chains(60, 4) + [(500 + i, f"alone{i} rare pair here {rng.random()}") for i in range(4)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    counts, texts = Counter(), 0
    for i, t in docs:
        if _crc(i) % 10:
            texts += 1
            seq = ["<s>", *t.split(), "</s>"]
            counts.update(tuple(seq[k : k + n]) for n in (1, 2, 3) for k in range(len(seq) - n + 1))
    words = {g: c for g, c in counts.items() if len(g) == 1 and g != ("<s>",)}
    twice = {g for g, c in counts.items() if c >= 2 and len(g) > 1}
    after: dict = {}
    for g in twice:
        after.setdefault(g[:-1], []).append(counts[g])
    uni = lm.UnigramModel(sum(words.values()), len(words), sum(c == 1 for c in words.values()), sum(c == 2 for c in words.values()))

    def p(context, word):
        if not context:
            return float(uni.probability(np.array([counts[(word,)]]))[0])
        kept, whole = after.get(context, []), counts[context]
        left = (whole - sum(kept) + lm.DISCOUNT * len(kept)) / whole if kept else 1.0
        own = (counts[(*context, word)] - lm.DISCOUNT) / whole if (*context, word) in twice else 0.0
        return own + left * p(context[1:], word)

    want = {}
    for i, t in docs:
        seq = ["<s>", *t.split(), "</s>"]
        want[i] = sum(math.log10(p(tuple(seq[max(0, k - 2) : k]), seq[k])) for k in range(1, len(seq)))
    got = {r.doc_id: r.score for r in lm.score_documents(df).collect()}
    assert got == {i: pytest.approx(v, abs=1e-8) for i, v in want.items()}


def test_lm_empty_table_and_no_training(spark):
    assert lm.score_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    held = [(i, "some words") for i in range(200) if _crc(i) % 10 == 0]
    got = lm.score_documents(spark.createDataFrame(held, "doc_id long, text string")).collect()
    assert {(r.train_tokens, r.n_known, r.score, r.base_score) for r in got} == {(0, 0, 0.0, 0.0)}


def _counted(seqs, least=2):
    """A block of given texts (word numbers), counted by itself."""
    counts = Counter(tuple(s[i : i + n]) for s in seqs for n in (1, 2, 3) for i in range(len(s) - n + 1))
    b = object.__new__(lm.Block)
    b.words = np.array(sorted({w for s in seqs for w in s}), dtype=np.uint64)
    at = {w: i for i, w in enumerate(b.words.tolist())}
    two, three = (sorted(g for g in counts if len(g) == n) for n in (2, 3))
    place = {g: i for i, g in enumerate(two)}
    b.first, b.second = (np.array([at[g[i]] for g in two]) for i in (0, 1))
    b.key2 = np.zeros(len(two), dtype=np.uint64)
    three = [g for g in three if counts[g[:2]] >= least and counts[g[1:]] >= least]
    b.parent, b.tail = (np.array([place[g[i : i + 2]] for g in three]) for i in (0, 1))
    c = object.__new__(lm.Counted)
    c.block = b
    c.total, c.total2, c.total3 = (np.array([counts[g] for g in gs]) for gs in ([(w,) for w in b.words.tolist()], two, three))
    c.kept2, c.kept3 = c.total2 >= least, c.total3 >= least
    c.sum1, c.arcs1 = lm._sums(b.first[c.kept2], c.total2[c.kept2], len(b.words))
    c.sum2, c.arcs2 = lm._sums(b.parent[c.kept3], c.total3[c.kept3], len(two))
    tokens = sum(len(s) - 1 for s in seqs)
    types = [n for g, n in counts.items() if len(g) == 1 and g != (lm.START,)]
    return c, lm.UnigramModel(tokens, len(types), types.count(1), types.count(2)), at


def _random_seqs(seed, n=300):
    rng = random.Random(seed)
    words = list(range(10, 40))
    weights = [1 / (i + 1) for i in range(30)]
    return [[lm.START] + rng.choices(words, weights=weights, k=rng.randint(1, 9)) + [lm.END] for _ in range(n)]


def test_every_state_is_a_probability_distribution():
    c, unigrams, at = _counted(_random_seqs(2))
    auto = lm.automaton(c, unigrams)
    states = len(auto.failure_weight)
    assert states > 100  # word and bigram states
    words = np.array([i for w, i in at.items() if w != lm.START])
    for state in range(states):
        if state and auto.failure_target[state] == 0 and c.block.words[words].size == 0:
            continue
        _, gained = auto.step(np.full(len(words), state), words)
        # What is left of the unigrams is one unknown word, down all failure arcs.
        unknown, s = math.log10(unigrams.probability(np.array([0]))[0]), state
        while s:
            unknown += auto.failure_weight[s]
            s = auto.failure_target[s]
        assert (10**gained).sum() + 10**unknown == pytest.approx(1.0, abs=1e-9)


def test_lanes_read_what_one_traversal_reads(monkeypatch):
    seqs = _random_seqs(3, 80) + [[lm.START, lm.END], [lm.START] + [10, 11] * 200 + [lm.END]]
    c, unigrams, at = _counted(seqs)
    auto = lm.automaton(c, unigrams)
    tokens = np.array([at[w] for s in seqs for w in s])
    lengths = np.array([len(s) for s in seqs])
    starts = np.cumsum(lengths) - lengths
    want = []
    for a, n in zip(starts, lengths):
        state, total = np.zeros(1, dtype=np.int64), 0.0
        for k, word in enumerate(tokens[a : a + n]):
            state, gained = auto.step(state, np.array([word]))
            total += gained[0] if k else 0.0
        want.append(total)
    for lane in (1, 2, 3, 7, 1000):
        monkeypatch.setattr(lm, "LANE", lane)
        assert auto.walk(tokens, starts, lengths) == pytest.approx(want, abs=1e-9)


def test_the_query_walks_the_automaton(spark, monkeypatch):
    def halved(self, tokens, starts, lengths, walk=lm.Automaton.walk):
        return walk(self, tokens, starts, lengths) / 2

    df = spark.createDataFrame(_corpus(60, 6)[0], "doc_id long, text string")
    whole = {r.doc_id: r.score for r in lm.score_documents(df).collect()}
    monkeypatch.setattr(lm.Automaton, "walk", halved)
    half = {r.doc_id: r.score for r in lm.score_documents(df).collect()}
    assert half == {i: pytest.approx(v / 2) for i, v in whole.items()}


def test_ids_of_any_kind_repeated_and_null(spark):
    rows = [(None, "a b a b"), (None, "a b"), ("x", "a b"), ("x", "a b"), ("x", None), ("y", ""), ("z", "q " * 3000)]
    df = spark.createDataFrame(rows * 3, "doc_id string, text string").withColumn("block", F.lit("clash")).withColumn("words", F.lit(1))
    got = lm.score_documents(df).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((i, len((t or "").split()) + 1) for i, t in rows * 3)


def test_lm_query_on_held_out_documents(spark):
    rows = QUERIES["op7_lm_scoring"](spark, SF_SMOKE).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
