"""Near-duplicate components and repeated passages against brute force."""

import random

import numpy as np
import pytest

from sparktally.llm import neardup, substring, verify
from sparktally.llm.common import connected_components
from sparktally.llm.shingles import MinHash, hash_words, shingle_hashes, similar, words_of

WORDS = [f"w{i}" for i in range(4000)]


def _text(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


def _edit(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def _sets(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def _components(docs):
    sets = [(i, _sets(t)) for i, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            both = len(s & t)
            if s and t and i is not None and j is not None and 100 * both >= 75 * (len(s) + len(t) - both):
                parent[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return [(i, len(s), low[find(k)] if i is not None else None) for k, (i, s) in enumerate(sets)]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    docs = []
    for _ in range(30):
        base = _text(rng, rng.choice([3, 6, 30, 120, 400]))
        docs.append(base)
        for _ in range(rng.randint(0, 5)):
            docs.append(_edit(rng, base, rng.choice([0, 1, 2, 4, 8])))
    docs += ["", None, "  \n\t ", "one", "ONE", "one two three four five", "One  two\nthree four FIVE", "é É", "x " * 3000]
    rng.shuffle(docs)
    ids = list(range(len(docs)))
    rng.shuffle(ids)
    return list(zip(ids, docs))


def test_near_duplicates_match_brute_force(spark, corpus):
    rows = [(i, t, "n", 3) for i, t in corpus]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, node string, cluster int")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(_components(corpus))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = " ".join(WORDS[:20])
    docs = [(5, text), (5, text), (3, text + " more"), (None, text), (9, None), (5, "other words entirely here now")]
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(5, 16, 3, False), (5, 16, 3, False), (3, 17, 3, True), (None, 16, None, True), (9, 0, 9, True), (5, 1, 5, True)], key=str
    )
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(empty).collect() == []
    assert substring.repeated_passages(empty).collect() == []
    assert substring.remove_passages(empty).collect() == []


def test_large_cluster_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(verify, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(verify.chunk_counts, "__defaults__", (4000,))
    rng = random.Random(8)
    base = _text(rng, 200)
    docs = [(i, _edit(rng, base, 2)) for i in range(60)]
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(_components(docs))


def test_odd_sketch_flips_stay_under_the_bound():
    rng = random.Random(6)
    hasher = MinHash(neardup.SAMPLES, neardup.ROWS, neardup.BITS)
    most = 0
    for _ in range(60):
        base = _text(rng, 300)
        a = np.unique(shingle_hashes(hash_words(words_of(base))))
        b = np.unique(shingle_hashes(hash_words(words_of(_edit(rng, base, 8)))))
        if similar(a, b, 75):
            x, y = (np.frombuffer(hasher.odd_sketch(hasher.minima(s)), np.uint8) for s in (a, b))
            flips = int(np.bitwise_count(x ^ y).sum())
            differing = int((hasher.minima(a) != hasher.minima(b)).sum())
            assert flips <= 2 * differing
            most = max(most, flips)
    assert 0 < most <= neardup.max_flips()


def test_odd_sketches_estimate_the_similarity():
    """Estimates against true Jaccard similarities from 0.75 to 1."""
    rng = random.Random(16)
    hasher = MinHash(neardup.SAMPLES, neardup.ROWS, neardup.BITS)
    errors = []
    for changes in range(0, 13):
        for _ in range(12):
            base = [f"v{rng.randrange(10**6)}".encode() for _ in range(400)]
            other = list(base)
            for k in rng.sample(range(400), changes):
                other[k] = b"changed%d" % rng.randrange(10**6)
            a, b = (np.unique(shingle_hashes(hash_words(w))) for w in (base, other))
            both = len(np.intersect1d(a, b))
            true = both / (len(a) + len(b) - both)
            x, y = (np.frombuffer(hasher.odd_sketch(hasher.minima(s)), np.uint8) for s in (a, b))
            flips = int(np.bitwise_count(x ^ y).sum())
            assert (flips == 0) == (true == 1) or true < 1
            assert true < 0.75 or flips <= neardup.max_flips()
            errors.append(float(neardup.estimated(flips)) - true)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05
    assert neardup.estimated(0) == 1 and neardup.estimated(neardup.max_flips()) > 0.4


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (None, 3)]
    rng.shuffle(edges)
    rows = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [list(range(301)), list(range(1000, 1200)), [5000]]


def test_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(9)
    passages = [_text(rng, n) for n in (50, 52, 60, 90, 300)]
    docs, planted = [], []
    for k, p in enumerate(passages):
        for _ in range(4):
            a, b = _text(rng, rng.randint(0, 80)), _text(rng, rng.randint(0, 80))
            planted.append((k, len(docs)))
            docs.append(" ".join(x for x in (a, p, b) if x))
    clean = [len(docs) + i for i in range(20)]
    docs += [_text(rng, 150) for _ in clean]
    rows = [(i, t, 1, "x") for i, t in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int, node string")
    spans = substring.repeated_passages(df).collect()
    hit = {r.doc_id for r in spans}
    for k in range(len(passages)):
        members = [d for p, d in planted if p == k]
        assert set(members[1:]) <= hit and members[0] not in hit
        assert all(set(r.kept_in) <= set(members) for r in spans if r.doc_id in members)
        assert all(any(members[0] in r.kept_in for r in spans if r.doc_id == m) for m in members[1:])
    assert not hit & set(clean)
    out = {r.doc_id: r for r in substring.remove_passages(df).collect()}
    assert len(out) == len(docs)
    for k, d in planted:
        first = d == min(x for p, x in planted if p == k)
        assert (passages[k] in out[d].text) == first
    assert all(out[d].text == docs[d] for d in clean)
    assert out[0].node == "x" and df.columns == substring.remove_passages(df).columns


def test_near_equal_passages_and_own_repeats(spark):
    rng = random.Random(12)
    passage = _text(rng, 120)
    own = _text(rng, 60)
    docs = [(1, passage), (2, _edit(rng, passage, 3)), (7, own + " " + own), (8, None), (9, ""), (10, "short text"), (None, passage)]
    spans = substring.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id for r in spans} == {2}
    assert sum(r.end_word - r.start_word for r in spans) >= 60


def test_whole_passages_go(spark):
    """Nothing of a planted word range stays outside the kept copy."""
    rng = random.Random(21)
    docs, first, own = [], [], []
    for n in (49, 51, 55, 60, 90, 150):
        passage = _text(rng, n)
        for k in range(4):
            a, b = ([f"{side}{len(docs)}_{i}" for i in range(rng.randint(0, 60))] for side in "ab")
            first.append(k == 0)
            own.append(a + b)
            docs.append(" ".join([*a, passage, *b]))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    out = {r.doc_id: r.text.split() for r in substring.remove_passages(df).collect()}
    for i, words in out.items():
        assert words == docs[i].split() if first[i] else set(words) <= set(own[i])
        # A near-equal paragraph may reach three words past the passage.
        assert first[i] or len(words) >= len(own[i]) - 6


def _edited(rng, words, changes):
    out = list(words)
    for _ in range(changes):
        k, new = rng.randrange(len(out)), f"x{rng.random()}"
        kind = rng.choice(["change", "change", "add", "drop"])
        out[k : k + (kind != "add")] = [] if kind == "drop" else [new]
    return out


def test_recall_of_near_passages(spark):
    """Passages of 50 to 150 words with up to five changes, of those with a
    true similarity of 0.75 or more: nine in ten and more are found in every
    class, and little outside them goes."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    text = lambda n: rng.choices(vocabulary, k=n)
    docs, planted = [], []
    for size in (50, 51, 60, 75, 100, 150):
        for changes in range(6):
            for _ in range(12):
                passage = text(size)
                other = _edited(rng, passage, changes)
                sets = [np.unique(shingle_hashes(hash_words([w.encode() for w in p])).view(np.int64)) for p in (passage, other)]
                if similar(*sets, 75):
                    before = text(rng.randint(0, 60))
                    docs.append(" ".join(text(rng.randint(0, 50)) + passage + text(rng.randint(0, 50))))
                    docs.append(" ".join(before + other + text(rng.randint(0, 60))))
                    planted.append((size, changes, len(docs) - 1, len(before), len(before) + len(other)))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    spans = {}
    for r in substring.repeated_passages(df).collect():
        spans.setdefault(r.doc_id, []).append((r.start_word, r.end_word, r.kept_in))
    classes = {}
    for size, changes, doc, a, b in planted:
        own = [s for s in spans.get(doc, []) if doc - 1 in s[2]]
        covered = sum(max(0, min(b, e) - max(a, s)) for s, e, _ in own)
        outside = sum(e - s for s, e, _ in spans.get(doc, [])) - covered
        assert outside <= 3
        classes.setdefault((size, changes), []).append(covered / (b - a))
    assert len(classes) > 20
    print({k: round(float(np.mean([c > 0 for c in v])), 2) for k, v in classes.items()})
    assert all(np.mean([c > 0 for c in v]) >= 0.9 and np.mean(v) >= 0.9 for v in classes.values())
    assert not {doc - 1 for _, _, doc, _, _ in planted} & set(spans)


def test_passages_of_many_texts_and_chains_of_copies(spark):
    """A line in every text, whole copies, and copies of copies: one document
    keeps each, whatever order they come in."""
    rng = random.Random(31)
    line, body = _text(rng, 40), _text(rng, 200)
    near = _edit(rng, body, 3)
    nearer = _edit(rng, near, 3)
    docs = [(100 + i, " ".join([_text(rng, 30), line, _text(rng, 30)])) for i in range(150)]
    docs += [(300 + i, body) for i in range(20)] + [(400, near), (401, near), (500, nearer)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    out = {r.doc_id: r.text for r in substring.remove_passages(df).collect()}
    assert sum(line in t for t in out.values()) == 1 and line in out[100]
    assert out[300] == body and all(out[300 + i] == "" for i in range(1, 20))
    assert out[401] == "" and max(len(out[i].split()) for i in (400, 500)) <= 10
    texts = dict(docs)
    # The line goes from the other texts, and a word beside it only where the
    # kept text happens to go on with the same one.
    gone = [len(texts[100 + i].split()) - len(out[100 + i].split()) for i in range(1, 150)]
    assert set(gone) <= {40, 41, 42} and sum(gone) < 41 * len(gone)


def test_passages_that_the_smallest_holder_has_only_in_part(spark):
    """A smaller document holds less than a passage's 25 words, so the two that
    hold all of it must meet by themselves: exact passages, and such as have a
    changed word and no 25 equal words in a row."""
    rng = random.Random(77)
    docs, pairs, exact = [], [], []
    add = lambda words: docs.append((len(docs), " ".join([_text(rng, 30), *words, _text(rng, 30)])))
    for size in (25, 26, 28, 30, 40, 46):
        for _ in range(12):
            passage = rng.choices(WORDS, k=size)
            other = list(passage)
            if size >= 40:
                other[size // 2] = "changed"
            for at in {0, max(0, size - 22)}:
                add(passage[at : at + 22])
            add(passage)
            add(other)
            pairs.append((len(docs) - 1, len(docs) - 2))
            exact.append(size < 40)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = substring.repeated_passages(df).collect()
    found = {(r.doc_id, k) for r in rows for k in r.kept_in}
    assert {r.doc_id for r in rows} <= {later for later, _ in pairs}
    hit = [p in found for p in pairs]
    assert all(h for h, e in zip(hit, exact) if e)
    assert np.mean([h for h, e in zip(hit, exact) if not e]) >= 0.9


def test_a_phrase_in_many_texts_hides_no_passage(spark):
    """Twenty words stand in every text, a text of the smallest id included,
    twice; some texts share more around them, and copies of these are one
    class. Ranges found in both rounds are one range."""
    rng = random.Random(78)
    phrase = _text(rng, 20)
    docs = [(i, " ".join([_text(rng, 40), phrase, _text(rng, 40), phrase, _text(rng, 30)])) for i in range(60)]
    longer = [" ".join([_text(rng, 8), phrase, _text(rng, 8)]) for _ in range(3)]
    docs += [(100 + i, " ".join([_text(rng, 30), longer[i % 3], _text(rng, 30)])) for i in range(30)]
    docs += [(200 + i, docs[70][1]) for i in range(20)]
    rows = substring.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(6)).collect()
    by_doc = {r.doc_id: r for r in rows}
    assert len(by_doc) == len(rows)
    assert set(by_doc) == {*range(103, 130), *range(200, 220)}
    assert all(100 + i % 3 in by_doc[100 + i].kept_in for i in range(3, 30))
    assert all(docs[70][0] in by_doc[200 + i].kept_in for i in range(20))
    assert all(by_doc[200 + i].end_word == len(docs[70][1].split()) for i in range(20))


def test_smallest_places_are_those_of_every_paragraph():
    rng = np.random.default_rng(3)
    lengths = np.array([0, 10, 24, 25, 26, 90, 3, 400])
    order = rng.integers(0, 1 << 63, lengths.sum() + substring.SEED - 1).astype(np.uint64)[: lengths.sum()]
    want, at = set(), 0
    for n in lengths:
        for p in range(at, at + n - substring.PARAGRAPH + 1):
            span = order[p : p + substring.SPAN] >> np.uint64(32)
            want.add(p + int(span.argmin()))
        at += n
    assert substring.smallest_places(order, lengths).tolist() == sorted(want)


def test_alignment_over_changes():
    own = np.arange(1, 101, dtype=np.uint32)
    kept = np.concatenate([own[:30], [900, 901], own[31:60], own[62:], [777]]).astype(np.uint32)
    stretches = substring.aligned(own, kept, 40, 41)
    assert stretches == [(0, 0, 30), (31, 32, 29), (62, 61, 38)]
    assert substring.confirmed(own, kept, stretches) == [(0, 100)]
    other = np.where((own % 9 == 0) & (own < 60), 5000 + own, own).astype(np.uint32)
    regions = substring.run_regions(own, other, [70], [70])
    assert regions and regions[-1][1] == 100 and regions[0][0] > 30
    assert substring.run_regions(own, own[::-1].copy(), [0], [0]) == []


def test_both_neighbours_of_a_stretch_are_confirmed():
    """Three stretches are too many for one region, the middle one is similar
    with either neighbour."""
    own = np.arange(1, 57, dtype=np.uint32)
    kept = own.copy()
    kept[[16, 39]] = 900, 901
    stretches = substring.aligned(own, kept, 20, 20)
    assert stretches == [(0, 0, 16), (17, 17, 22), (40, 40, 16)]
    assert sorted(substring.confirmed(own, kept, stretches)) == [(0, 39), (17, 56)]


def test_near_copies_do_not_all_meet(spark, monkeypatch):
    """A text's pairs are bounded by its collisions, not by the other copies."""
    rng = random.Random(91)
    body, made, write = rng.choices(WORDS, k=150), [], substring.materialize

    def counted(df, name):
        out = write(df, name)
        if name in ("para-others", "para-certified"):
            made.append(out.count())
        return out

    monkeypatch.setattr(substring, "materialize", counted)
    docs = [(i, " ".join(w if rng.random() > 0.06 else f"x{rng.random()}" for w in body)) for i in range(160)]
    assert substring.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).count()
    assert 0 < sum(made) < 100 * len(docs)


def test_cutting():
    assert substring.cut_words("a b\nc  d é f", [(1, 3), (5, 9)]) == "a d é "
    assert substring.cut_words("a b", []) == "a b"
