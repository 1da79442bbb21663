"""Repeated-passage removal by paragraph MinHash banding.

A passage can be pasted anywhere, so every run of ``PARAGRAPH`` words of a
text is a paragraph, not what line breaks make one. A paragraph's MinHash
under one hash order is its smallest ``SEED``-word shingle; neighbouring
paragraphs mostly share it, so a text has about one distinct MinHash for every
nine words and band, and only these are stored.

1. Banding: two bands of one sample each. Paragraphs of ``PARAGRAPH`` equal
   words always collide; changed ones at a chance that the two bands make
   high. A passage of L words with a similarity of 0.75 or more has at most
   about L / 35 changed words, so some paragraph of it is nearly always
   unchanged.
2. Collisions: holders of a MinHash meet the holder of the smallest doc_id.
   Collisions of one text with one other text along one diagonal are a run.
3. Verification: a run is aligned word by word from its collisions outwards,
   over changed, missing and added words, as far as the texts agree again; the
   aligned region is confirmed if its sets of five-word shingles have a
   Jaccard similarity of 0.75 or more (regions below lose their ends until
   they reach it).
4. The rest: a collision outside all regions confirmed with the smallest
   holder is open, and its document meets the other holders of the MinHash.
   Holders of equal surroundings are one class, which its smallest stands for.
   A confirmed region either has ``PARAGRAPH`` equal words in a row, and then
   the smallest holder of these words is met; or two neighbouring stretches of
   ``SIDE`` equal words or more that are similar by themselves. For these the
   smallest class that shares the MinHash and a second one of the other side is
   met. What is then still open meets the smallest holder of each certificate:
   both stretches whole, as long as the words left out between them ask for, so
   that all holders are similar to it. Runs are verified like the first ones.
   No class meets all others, so pairs grow with the collisions. An end of a
   longer region that is similar only together with words beyond its
   neighbour is found only if a text met for other words has it.
5. A confirmed region links a document with one of a smaller doc_id, which
   keeps the passage; the document of the larger doc_id loses its region.

No step holds a group of colliding paragraphs: smallest holders are partial
aggregates, joins are between written tables, so a MinHash that a third of all
texts hold (a licence line) is split, and what a task holds is bounded by the
text and the regions that its own collisions ask for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparktally.llm.common import drop_scratch, materialize, mix64, small_batches, to_i64
from sparktally.llm.shingles import WIDTH, hash_words, shingle_hashes, similar, words_of

PARAGRAPH = 25  # words of a paragraph; also of the shortest passage that goes
SEED = 8  # words of the shingles that MinHashes are taken of
BANDS = 2
SPAN = PARAGRAPH - SEED + 1  # shingles of a paragraph
AROUND = 48  # words compared on both sides of a run's collisions
GRID = 32  # ends of the regions asked for, so that similar runs ask for one
DRIFT, BREAK = 8, 80  # words added or missing within a run; without a collision
PERCENT = 75
# With one change, (c + 4) words on its sides agree for c equal shingles, and
# c / (c + 9) >= 0.75: 35 words in all, so 11 beside 24.
SIDE = 11
NEXT = PARAGRAPH + 4 - SEED  # words from a collision to a side behind a change
# Words of a context around a collision, in reading direction: the collision's
# side has PARAGRAPH - 1 words at most (more are a line), then up to four words
# are left out, and a side as long as the similarity asks for follows.
LEAD = PARAGRAPH - 1 - SEED
OUT = 4
STEP = 4  # lengths of a side that are looked for together
SIDES = [32 + 3 * g for g in range(2 * OUT + 1)]  # equal words that g words left out of both texts ask for
TAIL = PARAGRAPH - 1 + OUT + SIDES[-1] - SIDE
MEET = 1000  # runs that come to a text at a time
_PLACE = np.uint64((1 << 32) - 1)  # words of a batch
_NONE = np.uint64((1 << 64) - 1)
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")
# What may be skipped between agreeing words: (own, kept) words, fewest first.
_SKIPS = sorted(((a, b) for a in range(5) for b in range(5) if a + b), key=lambda s: (s[0] + s[1], abs(s[0] - s[1])))


def smallest_places(order: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of the smallest value of every run of ``SPAN`` places inside the
    texts laid end to end, without repeats; ties to the left.

    ``order`` has a value per word, of which a text's last ``SEED - 1`` count
    for nothing, ``lengths`` the number of words of each text.
    """
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(order), dtype=np.uint64)
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = place.astype(np.int64) - first[text]
    # Upper bits of the value, then the place: the minimum is the leftmost.
    key = np.where(inside < (lengths - SEED + 1)[text], (order & ~_PLACE) | place, _NONE)
    # Minima of 16 by doubling; two of them cover a run.
    low = np.concatenate([key, np.full(SPAN, _NONE)])
    for step in (1, 2, 4, 8):
        low = np.minimum(low[:-step], low[step:])
    n = len(key)
    low = np.minimum(low[:n], low[SPAN - 16 : SPAN - 16 + n])
    return np.unique((low[inside < (lengths - PARAGRAPH + 1)[text]] & _PLACE).astype(np.int64))


def _slim(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text)).alias("text_id"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    ).where("doc_id IS NOT NULL")


def _min_hashes(slim: DataFrame) -> DataFrame:
    """key, doc_id, text_id, place (word number) of every distinct MinHash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "_text"):
            texts = [words_of(t) for t in batch.column("_text").to_pylist()]
            lengths = np.array([len(w) for w in texts], dtype=np.int64)
            if lengths.max(initial=0) < PARAGRAPH:
                continue
            # Words after the last text let every shingle be computed.
            hashes = np.append(hash_words([w for words in texts for w in words]), np.zeros(SEED - 1, np.uint64))
            shingles = shingle_hashes(hashes, SEED)
            last = np.cumsum(lengths)
            orders = (mix64(shingles ^ np.uint64(band * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) for band in range(BANDS))
            at = np.unique(np.concatenate([smallest_places(order, lengths) for order in orders]))
            row = np.searchsorted(last, at, side="right")
            rows = pa.array(row)
            place = pa.array((at - last[row] + lengths[row]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(to_i64(shingles[at])), batch.column("doc_id").take(rows), batch.column("text_id").take(rows), place],
                names=["key", "doc_id", "text_id", "place"],
            )

    return slim.mapInArrow(run, "key long, doc_id long, text_id long, place int")


def holders(slim: DataFrame) -> DataFrame:
    """key, doc_id, text_id, place, kept_doc (the key's smallest doc_id): every
    MinHash that several documents hold (a written table)."""
    held = materialize(_min_hashes(slim), "para-hashes")
    shared = materialize(
        held.groupBy("key").agg(F.min("doc_id").alias("kept_doc"), F.max("doc_id").alias("last"))
        .where("kept_doc != last").drop("last"),
        "para-shared",
    )
    found = materialize(held.join(shared, "key"), "para-found")
    drop_scratch(held, shared)
    return found


def colliding(found: DataFrame) -> DataFrame:
    """doc_id, text_id, place, kept_doc, kept_text, kept_place: every MinHash
    that a document shares with one of a smaller doc_id, and where the smallest
    holds it (a written table). ``others`` has the rest of the pairs."""
    kept = materialize(
        found.where("doc_id = kept_doc").groupBy("key").agg(F.min(F.struct("text_id", "place")).alias("at"))
        .select("key", F.col("at.text_id").alias("kept_text"), F.col("at.place").alias("kept_place")),
        "para-kept",
    )
    out = materialize(found.where("doc_id != kept_doc").join(kept, "key").drop("key").distinct(), "para-colliding")
    drop_scratch(kept)
    return out


def _hash_rows(table: np.ndarray) -> np.ndarray:
    odd = mix64(np.arange(1, table.shape[1] + 1, dtype=np.uint64)) | np.uint64(1)
    return mix64((table * odd).sum(axis=1, dtype=np.uint64))


def surroundings(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash of the words around each collision, as far as a run of
    ``PARAGRAPH`` words with it reaches."""
    around = PARAGRAPH - 1
    edge = np.ones(around, np.uint64)
    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([edge, hashes, edge]), 2 * around + SEED)
    parts = [_hash_rows(windows[places[a : a + 4096]]) for a in range(0, len(places), 4096)]
    return np.concatenate([np.empty(0, np.uint64), *parts])


def _any_open(at: np.ndarray, is_open: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, and whether any of each is open."""
    values, which = np.unique(at, return_inverse=True)
    return values, np.bincount(which.ravel(), weights=is_open, minlength=len(values)) > 0


def _shared_lines(hashes: np.ndarray, places: np.ndarray, is_open: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, place, open) of every ``PARAGRAPH`` words in a row that hold a
    collision; the place is that of their first word."""
    at = (places[:, None] - np.arange(PARAGRAPH - SEED + 1)).ravel()
    inside = (at >= 0) & (at <= len(hashes) - PARAGRAPH)
    at, is_open = _any_open(at[inside], np.repeat(is_open, PARAGRAPH - SEED + 1)[inside])
    return shingle_hashes(hashes, PARAGRAPH)[at], at, is_open


def _shared_sides(hashes: np.ndarray, places: np.ndarray, is_open: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, place, open) of every collision with each MinHash of ``SIDE``
    words to the right or left of it.

    One word repeated is one shingle, too few for a side of a change. So such
    words are no side, and a collision of one word repeated counts at the ends
    of the repetition, with the word that stands beside it.
    """
    n = len(hashes)
    ends = np.flatnonzero(np.append(hashes[1:] != hashes[:-1], True)) + 1
    run = np.searchsorted(ends, places, side="right")
    begin, end = np.append(0, ends)[run], ends[run]
    plain = end - places < SEED
    most = PARAGRAPH - 1 - SEED
    left = ~plain & (begin > 0) & (places - begin <= most)
    right = ~plain & (end < n) & (end - SEED - places <= most)
    eight = shingle_hashes(hashes, SEED)
    nine = shingle_hashes(hashes, SEED + 1)
    # Three kinds of a place: 0 by itself, 1 and 2 with the word before or after.
    at = np.concatenate([places[plain] * 3, begin[left] * 3 + 1, (end - SEED)[right] * 3 + 2])
    at, is_open = _any_open(at, np.concatenate([is_open[plain], is_open[left], is_open[right]]))
    at, kind = at // 3, at % 3
    own = np.where(kind == 0, eight[at], nine[np.clip(at - (kind == 1), 0, len(nine) - 1)] + kind.astype(np.uint64))
    view = np.lib.stride_tricks.sliding_window_view
    least = view(shingle_hashes(hashes), SIDE - WIDTH + 1).min(axis=1)
    same = view(hashes[1:] == hashes[:-1], SIDE - 1).all(axis=1)
    edge = np.zeros(SIDE + NEXT, np.uint64)
    sides = np.concatenate([edge, np.where(same, np.uint64(0), least), np.zeros(SIDE + SEED + NEXT, np.uint64)])
    out = []
    for k, first in enumerate((SEED, 1 - SIDE - NEXT)):
        rows = np.sort(sides[at[:, None] + (len(edge) + first + np.arange(NEXT))], axis=1)
        new = rows != 0
        new[:, 1:] &= rows[:, 1:] != rows[:, :-1]
        row = np.nonzero(new)[0]
        out.append((mix64(rows[new] * np.uint64(2 * k + 3) + own[row]), at[row], is_open[row]))
    return tuple(np.concatenate(x) for x in zip(*out))


_AT = ["doc_id", "text_id", "place"]


def _with_texts(slim: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts of doc_id, text_id, once each, with the ``rows`` of theirs (a
    list of structs of the other columns)."""
    others = [c for c in rows.columns if c not in ("doc_id", "text_id")]
    asked = rows.groupBy(F.col("doc_id").alias("own_doc"), F.col("text_id").alias("own_text")).agg(
        F.collect_list(F.struct(*others)).alias("rows")
    )
    texts = slim.join(asked, (F.col("doc_id") == F.col("own_doc")) & (F.col("text_id") == F.col("own_text")))
    return texts.select("doc_id", "text_id", "_text", "rows")


def _classes(slim: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (key, doc_id, text_id, place, open) with ``around``, the class
    of their surroundings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "_text"):
            out = []
            for k, content in enumerate(batch.column("_text").to_pylist()):
                own = pa.RecordBatch.from_struct_array(batch.column("rows")[k].values)
                around = surroundings(hash_words(words_of(content)), own.column("place").to_numpy())
                ids = [pa.repeat(batch.column(c)[k], own.num_rows) for c in ("doc_id", "text_id")]
                cols = [own.column("key"), *ids, own.column("place"), own.column("open"), pa.array(to_i64(around))]
                out.append(pa.RecordBatch.from_arrays(cols, names=["key", *_AT, "open", "around"]))
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    return _with_texts(slim, rows).mapInArrow(
        run, "key long, doc_id long, text_id long, place int, open boolean, around long"
    ).distinct()


def _meetings(slim: DataFrame, firsts: DataFrame) -> DataFrame:
    """near, key, doc_id, text_id, place, open: the shared lines and (``near``)
    sides of the classes' smallest holders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "_text"):
            out = []
            for k, content in enumerate(batch.column("_text").to_pylist()):
                own = pa.RecordBatch.from_struct_array(batch.column("rows")[k].values)
                hashes = hash_words(words_of(content))
                at = own.column("place").to_numpy().astype(np.int64), own.column("open").to_numpy(zero_copy_only=False)
                both = _shared_lines(hashes, *at), _shared_sides(hashes, *at)
                key, place, is_open = (np.concatenate(x) for x in zip(*both))
                near = np.arange(len(key)) >= len(both[0][0])
                ids = [pa.repeat(batch.column(c)[k], len(key)) for c in ("doc_id", "text_id")]
                cols = [pa.array(near), pa.array(to_i64(key)), *ids, pa.array(place.astype(np.int32)), pa.array(is_open)]
                out.append(pa.RecordBatch.from_arrays(cols, names=["near", "key", *_AT, "open"]))
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    return _with_texts(slim, firsts).mapInArrow(
        run, "near boolean, key long, doc_id long, text_id long, place int, open boolean"
    )


def others(slim: DataFrame, found: DataFrame, unmet: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Collisions, as ``colliding`` gives them, of the open ones among the
    holders ``found`` (``unmet``: key, doc_id, text_id, place) with the smallest
    holder of the words around, of a line and of a side; and the holders of
    sides: key, doc_id, text_id, place, open, first (written tables)."""
    marked = found.join(unmet.select("key").distinct(), "key").join(unmet.withColumn("open", F.lit(True)), ["key", *_AT], "left")
    classes = materialize(_classes(slim, marked.select("key", *_AT, F.coalesce("open", F.lit(False)).alias("open"))), "para-classes")
    as_kept = lambda at: [F.col(f"{at}.{c}").alias(k) for c, k in zip(_AT, ("kept_doc", "kept_text", "kept_place"))]
    first = materialize(
        classes.groupBy("key", "around").agg(F.min(F.struct(*_AT)).alias("first"), F.max("doc_id").alias("last"), F.max("open").alias("open")),
        "para-first",
    )
    copies = (
        classes.select("key", "around", *_AT)
        .join(first.where("open AND first.doc_id != last").select("key", "around", *as_kept("first")), ["key", "around"])
        .where("doc_id != kept_doc").select(*_AT, "kept_doc", "kept_text", "kept_place")
    )
    several = first.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    made = materialize(_meetings(slim, first.join(several, "key").select("first.*", "open")), "para-meetings")
    shared = (
        made.groupBy("near", "key").agg(F.min(F.struct(*_AT)).alias("first"), F.max("doc_id").alias("last"), F.max("open").alias("any"))
        .where("any AND first.doc_id != last").select("near", "key", "first")
    )
    met = materialize(made.join(shared, ["near", "key"]), "para-met")
    drop_scratch(made)
    equal = met.where("NOT near AND doc_id != first.doc_id").select(*_AT, *as_kept("first"))
    near = met.where("near AND open AND doc_id > first.doc_id").select(*_AT, *as_kept("first"))
    out = materialize(copies.union(equal).union(near).distinct(), "para-others")
    beside = materialize(met.where("near").select("key", *_AT, "open", F.col("first.doc_id").alias("first")), "para-beside")
    drop_scratch(classes, first, met)
    return out, beside


def _uncovered(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows`` whose collision is in none of the regions ``spans``."""
    ranges = spans.select(
        F.col("doc_id").alias("in_doc"), F.col("text_id").alias("in_text"), "start_word", "end_word"
    ).distinct()
    inside = (F.col("start_word") <= F.col("place")) & (F.col("place") + SEED <= F.col("end_word"))
    return rows.join(ranges, (F.col("doc_id") == F.col("in_doc")) & (F.col("text_id") == F.col("in_text")) & inside, "left_anti")


def _contexts(slim: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text_id, place, open) with ``words``: 32-bit hashes of
    the words around the place, 0 outside the text (a written table)."""
    before = TAIL - SEED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "_text"):
            out = []
            for k, content in enumerate(batch.column("_text").to_pylist()):
                own = pa.RecordBatch.from_struct_array(batch.column("rows")[k].values)
                words = np.concatenate([np.zeros(before, np.uint32), _short_hashes(content), np.zeros(TAIL, np.uint32)])
                view = np.lib.stride_tricks.sliding_window_view(words, before + TAIL)
                around = pa.array([w.tobytes() for w in view[own.column("place").to_numpy()]], pa.binary())
                ids = [pa.repeat(batch.column(c)[k], own.num_rows) for c in ("doc_id", "text_id")]
                out.append(pa.RecordBatch.from_arrays([*ids, own.column("place"), own.column("open"), around], names=[*_AT, "open", "words"]))
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    made = _with_texts(slim, rows).mapInArrow(run, "doc_id long, text_id long, place int, open boolean, words binary")
    # Repeated rows of a document bring a text twice.
    return materialize(made.groupBy(*_AT).agg(F.max("open").alias("open"), F.first("words").alias("words")), "para-contexts")


_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.append(np.uint64(1), np.full(LEAD + TAIL, _BASE)), dtype=np.uint64)


class _Sequences:
    """Hashes of word sequences of contexts, read to the right (the first half
    of the rows) and to the left; the collision begins at word ``LEAD``."""

    def __init__(self, words: list[bytes]):
        table = np.frombuffer(b"".join(words), np.uint32).reshape(len(words), -1)
        start = TAIL - SEED - LEAD
        self.words = np.concatenate([table[:, start:], table[:, ::-1][:, start:]]).astype(np.uint64)
        n, width = self.words.shape
        value = mix64(self.words + np.uint64(1))
        self.sums, self.gaps = np.zeros((n, width + 1), np.uint64), np.zeros((n, width + 1), np.int32)
        for k in range(width):
            self.sums[:, k + 1] = self.sums[:, k] * _BASE + value[:, k]
        np.cumsum(self.words == 0, axis=1, out=self.gaps[:, 1:])

    def of(self, row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.sums[row, end] - self.sums[row, begin] * _POWERS[end - begin]

    def whole(self, row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether the sequence is inside the text."""
        return self.gaps[row, end] == self.gaps[row, begin]

    def sides(self, row, at, skip, left, right, salt) -> tuple[np.ndarray, np.ndarray]:
        """Key of ``left`` words before ``at`` and ``right`` ones after the next
        ``skip``; whether all are inside the text."""
        after = at + skip
        key = self.of(row, at - left, at) * _POWERS[right] + self.of(row, after, after + right)
        return mix64(key ^ mix64(salt.astype(np.uint64))), self.whole(row, at - left, after + right)


def _branches(seq: _Sequences, n: int) -> tuple[np.ndarray, ...]:
    """(key, word behind, context, code) of all words from a collision to a
    place that may be a side's end; the code is the place and direction."""
    row, at = (x.ravel() for x in np.mgrid[0 : 2 * n, LEAD + SEED : LEAD + PARAGRAPH])
    code = at * 2 + (row >= n)
    key = mix64(seq.of(row, np.full_like(row, LEAD), at) ^ mix64(code.astype(np.uint64)))
    ok = seq.whole(row, np.full_like(row, LEAD), at)
    return key[ok], seq.words[row, at][ok], (row % n)[ok], code[ok]


def _changes(seq: _Sequences, n: int, context: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, words left out, context, code) of the ends of sides with ``SIDE``
    words after each number of words left out; the code has that number too."""
    context, code = np.repeat(context, OUT + 1), np.repeat(code, OUT + 1)
    skip = np.tile(np.arange(OUT + 1), len(code) // (OUT + 1))
    row, at = context + n * (code % 2), code // 2
    key, ok = seq.sides(row, at, skip, np.maximum(SIDE, at - LEAD), np.full_like(at, SIDE), code)
    left_out = seq.of(row, at, at + skip) + skip.astype(np.uint64)
    return key[ok], left_out[ok], context[ok], (code * 8 + skip)[ok]


def _splits(seq: _Sequences, n: int, context: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, words left out, context, code) of the words that certificates have
    in common whose first side has ``STEP`` lengths; the code has their number."""
    out = []
    row, at, skip = context + n * (code // 8 % 2), code // 16, code % 8
    for part, low in enumerate(range(SIDE, PARAGRAPH, STEP)):
        high = min(low + STEP, PARAGRAPH) - 1
        some = np.flatnonzero(at - LEAD <= high)
        r, p, k = row[some], at[some], skip[some]
        left, right = np.maximum(low, p - LEAD), np.full_like(p, max(SIDE, SIDES[1] - high))
        key, ok = seq.sides(r, p, k, left, right, code[some] // 8 * 4 + part)
        other = seq.of(r, p, p + k) + k.astype(np.uint64)
        out.append((key[ok], other[ok], context[some][ok], (code[some] * 4 + part)[ok]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _certificates(seq: _Sequences, n: int, context: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, words that the other text may leave out, context, code) of all
    pairs of sides that are similar whatever stands between them."""
    out = []
    part, code = code % 4, code // 4
    row, at, skip = context + n * (code // 8 % 2), code // 16, code % 8
    for g in range(1, 2 * OUT + 1):
        for left in range(SIDE, PARAGRAPH):
            some = np.flatnonzero((skip <= g) & (g - skip <= OUT) & (at - LEAD <= left) & (part == (left - SIDE) // STEP))
            r, p, k = row[some], at[some], skip[some]
            fits = np.full_like(p, SIDES[g] - left)
            key, ok = seq.sides(r, p, k, np.full_like(p, left), fits, (code[some] // 8 * 16 + g) * 64 + left)
            out.append((key[ok], (g - k)[ok].astype(np.uint64), context[some][ok], code[some][ok]))
    return tuple(np.concatenate(x) for x in zip(*out))


_KEYS = "key long, other long, doc_id long, text_id long, place int, open boolean, code int"


def _sequence_keys(contexts: DataFrame, made_by) -> DataFrame:
    """Rows of ``_KEYS`` that ``made_by`` makes of contexts (with ``codes``, if
    it takes any)."""
    coded = "codes" in contexts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "words", 1 << 17):
            seq = _Sequences(batch.column("words").to_pylist())
            given = ()
            if coded:
                lists = batch.column("codes")
                given = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy()), lists.flatten().to_numpy().astype(np.int64)
            key, other, context, code = made_by(seq, batch.num_rows, *given)
            own = [batch.column(c).take(pa.array(context)) for c in (*_AT, "open")]
            cols = [pa.array(to_i64(key)), pa.array(to_i64(other)), *own, pa.array(code.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=["key", "other", *_AT, "open", "code"])

    return contexts.mapInArrow(run, _KEYS)


def _several(contexts: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The contexts with the codes whose key an open collision shares with a
    smaller document that goes on with something else (a written table)."""
    made = materialize(keys, f"{name}-keys")
    # The smallest document and the last open one, and those of them that go
    # on with something else than these.
    ways = made.groupBy("key", "other").agg(F.min("doc_id").alias("first"), F.max(F.when(F.col("open"), F.col("doc_id"))).alias("last"))
    ends = (
        ways.groupBy("key").agg(
            F.count("*").alias("n"), F.min("first").alias("low"), F.max("last").alias("high"),
            F.min_by("other", "first").alias("low_way"), F.max_by("other", "last").alias("high_way"),
        )
        .where("n > 1 AND low < high").drop("n")
    )
    ends = ways.join(ends, "key").groupBy("key", "low", "high", "low_way", "high_way").agg(
        F.min(F.when(F.col("other") != F.col("low_way"), F.col("first"))).alias("next_low"),
        F.max(F.when(F.col("other") != F.col("high_way"), F.col("last"))).alias("next_high"),
    )
    larger = F.when(F.col("other") == F.col("low_way"), F.col("next_low")).otherwise(F.col("low")) < F.col("doc_id")
    smaller = F.when(F.col("other") == F.col("high_way"), F.col("next_high")).otherwise(F.col("high")) > F.col("doc_id")
    useful = (F.col("open") & larger) | smaller
    codes = made.join(ends, "key").where(useful).groupBy(*_AT).agg(F.collect_list("code").alias("codes"))
    out = materialize(contexts.join(codes, _AT), name)
    drop_scratch(made)
    return out


def certified(slim: DataFrame, beside: DataFrame, spans: DataFrame) -> DataFrame:
    """Collisions, as ``colliding`` gives them, of those still open after the
    regions ``spans`` with the smallest holder of each pair of sides around a
    change that are similar by themselves (a written table).

    Every key names such a pair of sides whole, so all its holders are similar
    to its smallest one, and rows grow with the collisions, whatever their
    groups. The first keys (one side, then ``SIDE`` words of the other) only
    leave out what has no partner.
    """
    marked = materialize(
        beside.withColumn("still", F.lit(False)).where("NOT open").unionByName(
            _uncovered(beside.where("open"), spans).withColumn("still", F.lit(True))
        ),
        "para-still",
    )
    # The first holder of a side was met; only others are left to meet.
    asked = (
        marked.groupBy("key").agg(
            F.min(F.when(F.col("doc_id") != F.col("first"), F.col("doc_id"))).alias("next"),
            F.max(F.when(F.col("still"), F.col("doc_id"))).alias("last"),
        )
        .where("next < last").select("key")
    )
    rows = beside.join(asked, "key").select("key", *_AT).join(
        marked.where("still").select("key", *_AT, F.lit(True).alias("still")), ["key", *_AT], "left"
    )
    rows = rows.groupBy(*_AT).agg(F.coalesce(F.max("still"), F.lit(False)).alias("open"))
    contexts = _contexts(slim, rows)
    drop_scratch(marked)
    ends = _several(contexts, _sequence_keys(contexts, _branches), "para-ends")
    drop_scratch(contexts)
    changes = _several(ends.drop("codes"), _sequence_keys(ends, _changes), "para-changes")
    drop_scratch(ends)
    splits = _several(changes.drop("codes"), _sequence_keys(changes, _splits), "para-splits")
    drop_scratch(changes)
    made = materialize(
        _sequence_keys(splits, _certificates).select("key", "other", *_AT, "open", (F.col("code") % 8).alias("skip")), "para-certificates"
    )
    drop_scratch(splits)
    # Per key the smallest holder that leaves out so many words at most.
    smallest = made.groupBy("key").agg(
        *[F.min(F.when(F.col("skip") <= k, F.col("doc_id"))).alias(f"least{k}") for k in range(OUT + 1)],
        F.max(F.when(F.col("open"), F.col("doc_id"))).alias("last"),
    )
    smallest = smallest.where(f"least{OUT} < last").select("key", F.array(*[f"least{k}" for k in range(OUT + 1)]).alias("least"))
    met = made.where("open").join(smallest, "key").withColumn("kept_doc", F.col("least")[F.col("other").cast("int")])
    met = materialize(met.where("kept_doc < doc_id").select("key", *_AT, "kept_doc").distinct(), "para-smallest")
    kept = met.select("key", "kept_doc").distinct().join(
        made.select("key", F.col("doc_id").alias("kept_doc"), F.col("text_id").alias("kept_text"), F.col("place").alias("kept_place")),
        ["key", "kept_doc"],
    )
    kept = kept.groupBy("key", "kept_doc").agg(F.min(F.struct("kept_text", "kept_place")).alias("at"))
    out = materialize(
        met.join(kept, ["key", "kept_doc"]).select(*_AT, "kept_doc", "at.kept_text", "at.kept_place").distinct(), "para-certified"
    )
    drop_scratch(made, met)
    return out


_RUN = "doc_id long, text_id long, kept_doc long, kept_text long, a int, b int, places array<int>, kept_places array<int>"


def _runs(pairs: DataFrame) -> DataFrame:
    """Collisions of a text with one other along one diagonal, and the words
    [a, b) of the other text that they ask for."""
    names = ["doc_id", "text_id", "kept_doc", "kept_text", "place", "kept_place"]

    def cut(table: pa.Table) -> pa.RecordBatch:
        doc, text, kept_doc, kept_text, place, kept_place = (table.column(c).to_numpy() for c in names)
        order = np.lexsort((kept_place, place, kept_text, kept_doc, text, doc))
        doc, text, kept_doc, kept_text, place, kept_place = (x[order] for x in (doc, text, kept_doc, kept_text, place, kept_place))
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (
            (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (kept_doc[1:] != kept_doc[:-1]) | (kept_text[1:] != kept_text[:-1])
            | (np.abs(np.diff(place - kept_place)) > DRIFT) | (np.diff(place) > BREAK)
        )
        first = np.flatnonzero(new)
        low, high = np.minimum.reduceat(kept_place, first), np.maximum.reduceat(kept_place, first)
        offsets = pa.array(np.append(first, len(doc)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (place, kept_place)]
        a = np.maximum(0, low - AROUND) // GRID * GRID
        b = -(-(high + SEED + AROUND) // GRID) * GRID
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x[first]) for x in (doc, text, kept_doc, kept_text)), pa.array(a, pa.int32()), pa.array(b, pa.int32()), *lists],
            names=["doc_id", "text_id", "kept_doc", "kept_text", "a", "b", "places", "kept_places"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last, still open text
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            doc, text = (table.column(c).to_numpy() for c in ("doc_id", "text_id"))
            if not len(doc):
                continue
            ends = np.flatnonzero((doc[1:] != doc[:-1]) | (text[1:] != text[:-1])) + 1
            open_from = int(ends[-1]) if len(ends) else 0
            held = table.slice(open_from)
            if open_from:
                yield cut(table.slice(0, open_from))
        if held is not None:
            yield cut(held)

    return pairs.select(*names).repartition("doc_id", "text_id").sortWithinPartitions("doc_id", "text_id").mapInArrow(run, _RUN)


def _short_hashes(text: str) -> np.ndarray:
    return (hash_words(words_of(text)) >> np.uint64(32)).astype(np.uint32)


def _regions(runs: DataFrame, slim: DataFrame) -> DataFrame:
    """kept_text, a, b, words: the words [a, b) of the texts that runs ask for
    as 32-bit hashes, once each."""
    asked = (
        runs.select("kept_doc", "kept_text", "a", "b").distinct()
        .groupBy("kept_doc", "kept_text").agg(F.collect_list(F.struct("a", "b")).alias("picks"))
    )
    texts = slim.join(asked, (F.col("doc_id") == F.col("kept_doc")) & (F.col("text_id") == F.col("kept_text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "_text"):
            out: list[list] = [[], [], [], []]
            for tid, text, picks in zip(*(batch.column(c).to_pylist() for c in ("text_id", "_text", "picks"))):
                words = _short_hashes(text)
                for p in picks:
                    for column, value in zip(out, (tid, p["a"], p["b"], words[p["a"] : p["b"]].tobytes())):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["kept_text", "a", "b", "words"])

    made = texts.select("text_id", "_text", "picks").mapInArrow(run, "kept_text long, a int, b int, words binary")
    # Repeated rows of a document bring a text twice.
    return made.groupBy("kept_text", "a", "b").agg(F.first("words").alias("words"))


def _agree(x: np.ndarray, y: np.ndarray) -> int:
    """How many words agree from the beginning."""
    n, at, step = min(len(x), len(y)), 0, 32
    while at < n:
        differ = x[at : min(n, at + step)] != y[at : min(n, at + step)]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, 4 * step
    return n


def _onwards(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int]]:
    """Stretches (begin in x, begin in y, words) that agree, from the beginning
    on, as far as ``WIDTH`` words agree again after a few that do not."""
    out = []
    i = j = 0
    while True:
        n = _agree(x[i:], y[j:])
        out.append((i, j, n))
        i, j = i + n, j + n
        p, q = x[i : i + 4 + WIDTH].tolist(), y[j : j + 4 + WIDTH].tolist()
        for a, b in _SKIPS:
            if a + WIDTH <= len(p) and b + WIDTH <= len(q) and p[a] == q[b] and p[a : a + WIDTH] == q[b : b + WIDTH]:
                i, j = i + a, j + b
                break
        else:
            return out


def aligned(own: np.ndarray, kept: np.ndarray, place: int, kept_place: int) -> list[tuple[int, int, int]]:
    """Stretches that agree around one collision, from left to right."""
    right = _onwards(own[place:], kept[kept_place:])
    left = _onwards(own[:place][::-1], kept[:kept_place][::-1])
    out = [(place - i - n, kept_place - j - n, n) for i, j, n in reversed(left) if n]
    out += [(place + i, kept_place + j, n) for i, j, n in right if n]
    joined: list[tuple[int, int, int]] = []
    for i, j, n in out:
        if joined and joined[-1][0] + joined[-1][2] == i and joined[-1][1] + joined[-1][2] == j:
            joined[-1] = (joined[-1][0], joined[-1][1], joined[-1][2] + n)
        else:
            joined.append((i, j, n))
    return joined


def _alike(own: np.ndarray, kept: np.ndarray, first: tuple[int, int, int], last: tuple[int, int, int]) -> bool:
    """Whether the region from one stretch to another is similar enough."""
    sides = own[first[0] : last[0] + last[2]], kept[first[1] : last[1] + last[2]]
    return similar(*(np.unique(shingle_hashes(x.astype(np.uint64)).view(np.int64)) for x in sides), PERCENT)


def _longest(own: np.ndarray, kept: np.ndarray, stretches: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Words [s, e) of the aligned regions whose shingles are similar enough:
    the shorter end stretch is left to itself as long as they are not."""
    first, last = 0, len(stretches)
    while first < last:
        s, e = stretches[first][0], stretches[last - 1][0] + stretches[last - 1][2]
        if e - s < PARAGRAPH:
            return []
        if last - first == 1 or _alike(own, kept, stretches[first], stretches[last - 1]):
            return _longest(own, kept, stretches[:first]) + [(s, e)] + _longest(own, kept, stretches[last:])
        if stretches[first][2] < stretches[last - 1][2]:
            first += 1
        else:
            last -= 1
    return []


def confirmed(own: np.ndarray, kept: np.ndarray, stretches: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Words [s, e) of the regions that ``_longest`` finds, and of all pairs of
    neighbours outside them that are similar by themselves, as a stretch of one
    region may be in another one with its other neighbour."""
    out = _longest(own, kept, stretches)
    for x, y in zip(stretches, stretches[1:]):
        s, e = x[0], y[0] + y[2]
        left_out = y[0] - x[0] - x[2] + y[1] - x[1] - x[2]
        if x[2] + y[2] >= SIDES[0] + 3 * left_out and not any(a <= s and e <= b for a, b in out) and _alike(own, kept, x, y):
            out.append((s, e))
    return out


def run_regions(own: np.ndarray, kept: np.ndarray, places: list[int], kept_places: list[int]) -> list[tuple[int, int]]:
    """Confirmed regions of a run; ``kept_places`` are places in ``kept``."""
    out: list[tuple[int, int]] = []
    seen = -1  # collisions before this word are in a region already looked at
    for place, kept_place in zip(places, kept_places):
        if place < seen or not np.array_equal(own[place : place + SEED], kept[kept_place : kept_place + SEED]):
            continue
        stretches = aligned(own, kept, place, kept_place)
        seen = stretches[-1][0] + stretches[-1][2]
        out += confirmed(own, kept, stretches)
    return out


def _verified(slim: DataFrame, pairs: DataFrame, last: bool = False) -> DataFrame:
    """doc_id, text_id, start_word, end_word, kept_in, key: the regions
    confirmed from ``pairs`` (key NULL); then, unless it is the ``last`` round,
    the collisions outside every region of their run, with their key (a
    written table)."""
    runs = materialize(_runs(pairs), "para-runs")
    drop_scratch(pairs)
    regions = materialize(_regions(runs, slim), "para-regions")
    # The regions travel to the texts that repeat them.
    # After the first round a text may meet very many others.
    number = F.row_number().over(Window.partitionBy("doc_id", "text_id").orderBy("kept_doc"))
    part = F.floor((number - 1) / MEET) if last else F.lit(0)
    given = materialize(
        runs.join(regions, ["kept_text", "a", "b"]).withColumn("part", part).groupBy("doc_id", "text_id", "part")
        .agg(F.collect_list(F.struct("kept_doc", "a", "places", "kept_places", "words")).alias("runs"))
        .select(F.col("doc_id").alias("own_doc"), F.col("text_id").alias("own_text"), "runs"),
        "para-given",
    )
    drop_scratch(runs, regions)
    texts = slim.join(given, (F.col("doc_id") == F.col("own_doc")) & (F.col("text_id") == F.col("own_text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "_text"):
            rows: list[tuple] = []
            for k, (doc, tid, content) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_id", "_text")))):
                hashes = hash_words(words_of(content))
                own = (hashes >> np.uint64(32)).astype(np.uint32)
                found: list[tuple[int, int, int]] = []
                for r in batch.column("runs")[k].as_py():
                    kept = np.frombuffer(r["words"], np.uint32)
                    there = [p - r["a"] for p in r["kept_places"]]
                    good = run_regions(own, kept, r["places"], there)
                    found += [(s, e, r["kept_doc"]) for s, e in good]
                    if last:
                        continue
                    unmet = [p for p in r["places"] if not any(s <= p and p + SEED <= e for s, e in good)]
                    keys = to_i64(np.concatenate([np.empty(0, np.uint64), *(shingle_hashes(hashes[p : p + SEED], SEED) for p in unmet)]))
                    rows += [(doc, tid, p, p + SEED, None, key) for p, key in zip(unmet, keys.tolist())]
                rows += [(doc, tid, s, e, kept_doc, None) for s, e, kept_doc in set(found)]
            cols = list(zip(*rows)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            names = ["doc_id", "text_id", "start_word", "end_word", "kept_in", "key"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    out = materialize(
        texts.select("doc_id", "text_id", "_text", "runs").mapInArrow(
            run, "doc_id long, text_id long, start_word int, end_word int, kept_in long, key long"
        ),
        "para-verified",
    )
    drop_scratch(given)
    return out


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per removed word range: doc_id, text_id (xxhash64 of the text),
    start_word, end_word (exclusive), kept_in (sorted doc_ids, all smaller,
    that its passages repeat).

    Documents without a repeated passage give no row: NULL, empty and short
    texts (under 25 words) never do, nor do rows with NULL doc_id. Repeated
    rows of one doc_id are one document and lose nothing to each other. Other
    columns are ignored, whatever their names.
    """
    slim = _slim(docs, doc_id, text)
    found = holders(slim)
    spans = _verified(slim, colliding(found))
    unmet = materialize(
        spans.where("key IS NOT NULL").select("key", "doc_id", "text_id", F.col("start_word").alias("place")).distinct(), "para-open"
    )
    spans = spans.where("key IS NULL")
    if not unmet.isEmpty():
        pairs, beside = others(slim, found, unmet)
        spans = spans.union(_verified(slim, pairs, last=True).where("key IS NULL"))
        spans = spans.union(_verified(slim, certified(slim, beside, spans), last=True).where("key IS NULL"))
        drop_scratch(beside)
    drop_scratch(found, unmet)
    # Ranges that touch become one.
    before = Window.partitionBy("doc_id", "text_id").orderBy("start_word", "end_word")
    reached = F.max("end_word").over(before.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (F.col("start_word") > reached), 1).otherwise(0)
    return (
        spans.withColumn("_new", begins).withColumn("_range", F.sum("_new").over(before))
        .groupBy("doc_id", "text_id", "_range")
        .agg(
            F.min("start_word").alias("start_word"),
            F.max("end_word").alias("end_word"),
            F.array_sort(F.collect_set("kept_in")).alias("kept_in"),
        )
        .drop("_range")
    )


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the given word ranges and the white space after them."""
    raw = text.encode("utf-8")
    starts = [m.start() for m in _WORD.finditer(raw)] + [len(raw)]
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= len(starts) - 1:
            break
        out.append(raw[at : starts[a]])
        at = starts[min(b, len(starts) - 1)]
    out.append(raw[at:])
    return b"".join(out).decode("utf-8")


def remove_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut from ``text`` (and n_chars, if
    present, set to the new length). All rows stay, in all their columns."""
    spans = materialize(
        repeated_passages(docs, doc_id, text)
        .groupBy("doc_id", "text_id")
        .agg(F.collect_list(F.struct("start_word", "end_word")).alias("_spans"))
        .select(F.col("doc_id").alias("_span_doc"), F.col("text_id").alias("_span_text"), "_spans"),
        "para-spans",
    )

    @F.pandas_udf("string")
    def cut(texts, lists):
        pairs = zip(texts, lists)
        return pd.Series([None if s is None else cut_words(t, [(x["start_word"], x["end_word"]) for x in s]) for t, s in pairs])

    # Positions for names, which cannot clash with those of the join.
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own, content = F.col(place[doc_id]), F.col(place[text])
    joined = docs.select([F.col(c).alias(p) for c, p in place.items()]).join(
        spans, (own == F.col("_span_doc")) & (F.xxhash64(content) == F.col("_span_text")), "left"
    )
    # Texts without spans do not travel to Python.
    some = F.col("_spans").isNotNull()
    joined = joined.withColumn("_cut", cut(F.when(some, content), F.when(some, F.col("_spans"))))
    new = {text: F.col("_cut")}
    if "n_chars" in place:
        new["n_chars"] = F.length("_cut").cast(docs.schema["n_chars"].dataType)
    return joined.select([(F.when(some, new[c]).otherwise(F.col(p)) if c in new else F.col(p)).alias(c) for c, p in place.items()])
