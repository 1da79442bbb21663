"""Top-k against full computation, WARC round trips, fingerprints."""

import hashlib
import random

import numpy as np
import pytest

from sparktally.llm import fingerprint, topk, warc
from sparktally.session import scratch_path


def _best(rows, queries, k):
    out = []
    for q, v in queries.items():
        scores = []
        for i, w in rows:
            if i != q:
                scores.append((-sum(a * b for a, b in zip(v, w)), i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_top_k_matches_full_computation(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "SCORES", 100)
    rng = random.Random(4)
    rows = [(i, [rng.choice([0, 0, 1, -2, 3]) for _ in range(rng.choice([6, 6, 4]))]) for i in range(300)]
    rows += [(500 + i, [1, 1, 1, 1, 1, 1]) for i in range(60)] + [(7, rows[7][1]), (600, []), (601, [10**6] * 6)]
    bad = [(900, None), (901, [1, None, 2]), (None, [1, 2])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], "vec_id long, vector array<long>, score int")
    got = topk.top_k(df, df.where("vec_id % 20 = 0"), 20).collect()
    queries = {i: v for i, v in rows if i % 20 == 0}
    assert sorted(map(tuple, got)) == _best(rows, queries, 20)


def test_a_repeated_query_is_answered_by_its_smallest_vector(spark):
    rows = [(1, [5, 0]), (1, [2, 0]), (1, [2, 1]), (2, [3, 1]), (3, [0, 4])]
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(3)
        got = topk.top_k(df, df.where("vec_id = 1"), 5).collect()
        assert sorted(map(tuple, got)) == [(1, 1, 2, 6), (1, 2, 3, 0)]


def test_large_weights_leave_the_narrow_type(spark):
    rows = [(1, [2**31, 1]), (2, [2**30, 5]), (3, [-(2**31), 0])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    got = topk.top_k(df, df.where("vec_id = 1"), 5).collect()
    assert [tuple(r) for r in got] == [(1, 1, 2, 2**61 + 5), (1, 2, 3, -(2**62))]


def test_embeddings_with_bad_components_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.01]), (20, [nan, 1.0]), (1, [inf, 0.0]), (2, [0.25, 1.0]), (3, None), (4, [None, 1.0]), (40, [0.1, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {tuple(r) for r in topk.search_embeddings(df).collect()}
    assert got == {(0, 1, 2, 32 * 16 - 64), (0, 2, 40, 32 * 6 - 6), (40, 1, 2, 6 * 16 + 6 * 64), (40, 2, 0, 6 * 32 - 6)}
    assert topk.search_embeddings(df.limit(0)).collect() == []


LONG = "x" * 150
PAGES = [
    (5, "http://a", LONG), (3, "http://b", LONG), (9, None, LONG), (3, "http://b", LONG), (None, "http://n", LONG),
    (1, "http://c\r\nX: y", "short"), (2, "http://d", "short"), (4, "u", None), (6, "u", ""), (7, "u", "é" * 50), (8, "u", "é" * 50),
    (10, "u", "a\r\n\r\nb" * 40), (11, "u", "z" * 300_000),
]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, digest string")


def test_archive_digests(pages):
    rows = warc.archive_pages(pages).collect()
    first = {}
    for i, _, html in PAGES:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        low = first[html or ""]
        again = len(body) >= 100 and i != low
        want.append((str(i), len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", low if again else None))
    got = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_records_come_back_whole(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "SHARE_ROWS", 2)
    path = scratch_path(spark, "warc-test-" + hashlib.md5(str(random.random()).encode()).hexdigest())
    warc.write_archive(pages, path)
    assert spark.read.parquet(f"{path}/payloads").count() == len({(h or "") for _, _, h in PAGES})
    rows = warc.read_archive(spark, path).collect()
    assert len(rows) == len(PAGES)
    html = {i: (h or "").encode() for i, _, h in PAGES}
    for r in rows:
        assert bytes(r.payload) == html[r.page_id]
        head, body = bytes(r.record).split(b"\r\n\r\n", 1)
        lines = head.split(b"\r\n")
        fields = dict(line.split(b": ", 1) for line in lines[1:])
        assert lines[0] == b"WARC/1.1" and b"X" not in fields
        stored = html[r.page_id] if r.record_type == "response" else b""
        assert body == stored + b"\r\n\r\n" and int(fields[b"Content-Length"]) == len(stored)
        assert fields[b"WARC-Payload-Digest"] == b"sha256:" + hashlib.sha256(html[r.page_id]).hexdigest().encode()


def test_damaged_payload_fails_and_empty_archive(spark, pages):
    path = scratch_path(spark, "warc-damaged-" + str(random.random()))
    warc.write_archive(pages, path)
    other = spark.read.parquet(f"{path}/payloads").selectExpr("digest", "concat(payload, X'00') AS payload", "shares")
    other.write.parquet(f"{path}-2/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}-2/headers")
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_archive(spark, f"{path}-2").collect()
    assert warc.archive_pages(pages.limit(0)).collect() == []


def test_missing_payload_or_other_digest_fails_the_read(spark, pages):
    path = scratch_path(spark, "warc-missing-" + str(random.random()))
    warc.write_archive(pages, path)
    payloads, headers = (spark.read.parquet(f"{path}/{t}") for t in ("payloads", "headers"))
    lost = payloads.agg({"digest": "min"}).first()[0]
    payloads.where(f"digest != '{lost}'").write.parquet(f"{path}-2/payloads")
    headers.write.parquet(f"{path}-2/headers")
    payloads.write.parquet(f"{path}-3/payloads")
    other = "cast(replace(cast(header AS string), 'sha256:', 'sha256:0') AS binary) AS header"
    headers.selectExpr("digest", "share", "page_id", other).write.parquet(f"{path}-3/headers")
    for damaged in (f"{path}-2", f"{path}-3"):
        with pytest.raises(Exception, match="missing or does not have its digest"):
            warc.read_archive(spark, damaged).select("page_id", "payload_digest").collect()


def _edited(docs):
    out = []
    for k, (i, t) in enumerate(docs):
        nxt = docs[(k + 1) % len(docs)][1]
        cut = len(t) // 4
        out.append((i, t, t[: len(t) - cut] + nxt[:cut], nxt))
    return out


@pytest.mark.parametrize("range_bytes", [1 << 30, 2000])
def test_fingerprints_of_edited_texts(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(fingerprint, "RANGE_BYTES", range_bytes)
    rng = random.Random(2)
    docs = [(i * 3, "".join(rng.choices("abcdefgh  é😀", k=rng.choice([0, 1, 5, 9, 200, 900])))) for i in range(60)]
    docs += [(1000, "same text " * 30), (1001, "same text " * 30), (1003, "w" * 20_000)]
    rows = [(i, t or None, 4) for i, t in docs]
    rng.shuffle(rows)
    got = {r.doc_id: r for r in fingerprint.compare_edited(spark.createDataFrame(rows, "doc_id long, text string, part int")).collect()}
    assert len(got) == len(docs)
    alone = fingerprint.OrderMinHash()
    mark = lambda t: alone.fingerprint(fingerprint.code_points(t))
    for i, text, edited, nxt in _edited(docs):
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == mark(text).tobytes().hex()
        assert r.edited_fingerprint == mark(edited).tobytes().hex()
        assert r.near_edited == fingerprint.likeness(mark(text), mark(edited))
        assert r.near_next == fingerprint.likeness(mark(text), mark(nxt))
    assert got[1000].fingerprint == got[1001].fingerprint and got[1000].near_next == 1.0


def test_single_null_repeated_and_no_rows(spark):
    one = fingerprint.compare_edited(spark.createDataFrame([(4, "abcdefgh")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.edited_sha256) for r in one] == [(4, hashlib.sha256(b"abcdefab").hexdigest())]
    rows = [(None, "first text here"), (2, "bb" * 20), (2, "aa" * 20), (2, "aa" * 20), (7, None)]
    got = fingerprint.compare_edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.doc_id for r in got].count(2) == 3 and len(got) == 5
    assert fingerprint.compare_edited(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_order_minhash_sees_order_and_occurrences():
    rng = random.Random(3)
    hasher = fingerprint.OrderMinHash()
    mark = lambda t: hasher.fingerprint(fingerprint.code_points(t))
    text = "".join(rng.choices("abcdefghijklmnop", k=2000))
    moved = text[1000:] + text[:1000]
    small = text[:500] + "XY" + text[500:]
    assert fingerprint.likeness(mark(text), mark(small)) > 0.8
    assert fingerprint.likeness(mark(text), mark(moved)) < fingerprint.likeness(mark(text), mark(small)) - 0.2
    assert list(hasher.occurrences(np.array([5, 9, 5, 5, 9], dtype=np.uint64) << np.uint64(40))) == [0, 0, 1, 2, 1]
    assert fingerprint.likeness(mark("ab" * 50), mark("ab" * 500)) < 1.0


def test_ranges_are_counted_bounds(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "RANGE_BYTES", 40)
    rows = [(i * 7 % 1000, "x" * 20) for i in range(500)] + [(None, "y"), (-5, "z")]
    ranged, parts = fingerprint._ranged(spark.createDataFrame(rows, "doc_id long, _text string"))
    got = [(r.doc_id, r.part) for r in ranged.collect()]
    assert parts > 50 and {p for _, p in got} <= set(range(parts))
    known = sorted(g for g in got if g[0] is not None)
    assert [p for _, p in known] == sorted(p for _, p in known) and known[0] == (-5, 0)
    assert dict(got)[None] == 0 and known[-1][1] == parts - 1
    monkeypatch.setattr(fingerprint, "RANGES", 3)
    assert fingerprint._ranged(spark.createDataFrame(rows, "doc_id long, _text string"))[1] <= 3


def test_order_minhash_step_by_step():
    """Every permutation in plain Python: number equal k-mers, order them by
    the permuted number, take the first two in text order."""
    mask = (1 << 64) - 1

    def mix(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & mask
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    hasher = fingerprint.OrderMinHash(hashes=6)
    step = int(fingerprint._M)
    rng = random.Random(12)
    for text in ["", "a", "abc", "abcdefgh", "abababababababababab", "".join(rng.choices("abcé😀 ", k=90)), "x" * 40]:
        points, k = [ord(c) for c in text], min(8, len(text))
        grams = []
        for i in range(len(points) - k + 1 if points else 0):
            h = k
            for p in points[i : i + k]:
                h = (h * step + p) & mask
            grams.append(mix(h))
        slots = []
        for mul, add in zip(hasher.mul.tolist(), hasher.add.tolist()):
            values = []
            for i, g in enumerate(grams):
                number = mix((g + grams[:i].count(g) * step) & mask) >> 32
                values.append(((mul * number + add) & 0xFFFFFFFF, i))
            chosen = sorted(i for _, i in sorted(values)[:2])
            slot = len(chosen)
            for i in chosen:
                slot = mix((slot * step + grams[i]) & mask)
            slots.append(slot >> 32 if chosen else 0)
        assert hasher.fingerprint(fingerprint.code_points(text)).tolist() == slots
