"""Best-fit packing by exact-complement hashing.

The packing plan depends only on how many pieces there are of each length,
at most ``size`` numbers whatever the corpus, so those counts (a partial
aggregate) go to the driver and the plan is made there: the largest length
opens a sequence, and the gap is closed by a single, a pair or a triple of
available lengths that sum to it exactly, looked up in an index of sums; if
no combination fits exactly, the largest length that fits goes in (best fit)
and the smaller gap is tried again. One plan looks at every pair and triple,
another at those led by one of the ``NEAR`` largest lengths that fit, as small
lengths spent early may be missed later; the one of fewer sequences is taken. A finished pattern is repeated as often as the counts allow,
so the plan has a few thousand patterns at most.

Pieces get their place by their rank among the pieces of equal length. Ranks
are counted in hash buckets of the piece, with one prefix sum over (bucket,
length) counts, so a length shared by a third of all pieces is numbered by
many tasks.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparktally.llm.bpe import PRETOKEN_PATTERN, TextEncoder, Vocabulary, trie_units
from sparktally.llm.common import materialize, no_collection, partitions_for, small_batches

SEQUENCE = 1024
END_ID = 2
LONG_TEXT = 500_000  # beyond: the other encoder, which gives the same ids
NEAR = 8  # lengths tried as the largest of an exact pair or triple in the second plan


def text_encoder(vocab: Vocabulary):
    """A function from a text to its ids as little-endian 32-bit integers.

    A vocabulary whose ids follow the merge order is encoded by tiktoken's
    rank form of the same merges, which takes whole texts; texts beyond
    ``LONG_TEXT`` characters (its pattern engine gives up on very long runs of
    white space) and any other vocabulary go through the trie encoder.
    """
    pieces = TextEncoder(trie_units(vocab), lambda ids: array("I", ids).tobytes(), vocab.special)
    whole = lambda text: b"".join(next(pieces.encode([text])))
    order = [vocab.ids.get(x + y, -1) for x, y in vocab.ranks]
    if order != sorted(set(order)) or max((vocab.ids[bytes([b])] for b in range(256)), default=0) >= order[0]:
        return whole
    fast = tiktoken.Encoding("vocabulary", pat_str=PRETOKEN_PATTERN, mergeable_ranks=vocab.ids, special_tokens={})

    def encode(text: str) -> bytes:
        if len(text) > LONG_TEXT or any(mark in text for mark in vocab.special):
            return whole(text)
        return array("I", fast.encode_ordinary(text)).tobytes()

    return encode


def token_pieces(
    docs: DataFrame, tokenizer_json: str, size: int = SEQUENCE, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document.

    A document is the ids of its text (NULL: none) and ``end_id``. Documents
    longer than ``size`` are cut into pieces of ``size`` ids, of which the
    first may be shorter; an empty text gives one piece of length 1. One row
    per piece and input row (repeated rows give repeated pieces); other
    columns are ignored, whatever their names.
    """
    source = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with no_collection():
            vocab = Vocabulary(source.value)
            encode = text_encoder(vocab)
            end = end_id.to_bytes(4, "little")
            for batch in small_batches(batches, "_text"):
                row, piece, start, length, crc = [], [], [], [], []
                for k, text in enumerate(batch.column("_text").to_pylist()):
                    ids = encode(text) + end
                    n = len(ids) // 4
                    a, b, i = 0, n % size or size, 0
                    while a < n:
                        row.append(k)
                        piece.append(i)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[4 * a : 4 * b]))
                        a, b, i = b, b + size, i + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(row, pa.int64())),
                        pa.array(piece, pa.int32()),
                        *(pa.array(v, pa.int64()) for v in (start, length, crc)),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return slim.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class ComplementIndex:
    """Available lengths and the sums that one, two or three of them make."""

    def __init__(self, counts: dict[int, int]):
        self.left = Counter({n: c for n, c in counts.items() if c > 0})
        self._index()

    def _index(self) -> None:
        bits = 0
        for n in self.left:
            bits |= 1 << n
        pairs = 0
        for n, c in self.left.items():
            pairs |= (bits if c > 1 else bits & ~(1 << n)) << n
        self.single, self.pair = bits, pairs
        self.order = sorted(self.left, reverse=True)

    def take(self, pattern: Counter, times: int) -> None:
        """Consume a pattern; the index is rebuilt when a length runs out or
        down to its last piece."""
        stale = False
        for n, k in pattern.items():
            self.left[n] -= k * times
            if self.left[n] <= 1:
                stale = True
                if self.left[n] == 0:
                    del self.left[n]
        if stale:
            self._index()

    def _has(self, items: Counter) -> bool:
        return all(self.left[n] >= k for n, k in items.items())

    def exact(self, gap: int, used: Counter, near: int | None = None) -> Counter | None:
        """One, two or three available lengths beyond ``used`` of sum ``gap``,
        the largest first; None only if there are none. ``near``: the larger
        ones of two or three are among that many largest that fit."""
        if self.single >> gap & 1 and self._has(used + Counter([gap])):
            return Counter([gap])
        leading = [a for a in self.order if a < gap][:near]
        return self._two(gap, used, leading) or self._three(gap, used, leading, near)

    def _two(self, gap: int, used: Counter, leading: list[int]) -> Counter | None:
        for a in leading if self.pair >> gap & 1 else ():
            if self.single >> (gap - a) & 1 and self._has(used + Counter([a, gap - a])):
                return Counter([a, gap - a])
        return None

    def _three(self, gap: int, used: Counter, leading: list[int], most: int | None) -> Counter | None:
        for a in leading:
            rest = gap - a
            if 3 * a < gap:
                break
            if not self.pair >> rest & 1:
                continue
            for b in [b for b in self.order if b < rest and b <= a][:most]:
                if 2 * b < rest:
                    break
                if self.single >> (rest - b) & 1 and self._has(used + Counter([a, b, rest - b])):
                    return Counter([a, b, rest - b])
        return None


def _plan(counts: dict[int, int], size: int, near: int | None) -> list[tuple[int, Counter]]:
    index = ComplementIndex(counts)
    plan = []
    while index.left:
        first = index.order[0]
        pattern, gap = Counter([first]), size - first
        while gap:
            found = index.exact(gap, pattern, near)
            if found is None:
                best = next((n for n in index.order if n <= gap and index.left[n] > pattern[n]), 0)
                if not best:
                    break
                found = Counter([best])
            pattern += found
            gap = size - sum(n * k for n, k in pattern.items())
        times = min(index.left[n] // k for n, k in pattern.items())
        plan.append((times, pattern))
        index.take(pattern, times)
    return plan


def plan_patterns(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, Counter]]:
    """(times, pattern) list using every piece once; a pattern's lengths sum
    to at most ``size``. The largest length left opens a pattern; its gap is
    closed by an exact complement, or the largest length that fits goes in and
    the rest of the gap is tried again. A pattern is used as often as its
    pieces are there. Of the plan with all complements and the one that leaves
    those not led by large lengths for later, the one of fewer sequences."""
    return min((_plan(counts, size, near) for near in (None, NEAR)), key=lambda plan: sum(times for times, _ in plan))


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``pieces`` (a written table with a ``length`` of 1 to ``size`` and the
    identifying columns doc_id, piece, start) with sequence_id and offset.

    Every row gets its own place: sequences hold at most ``size`` ids and
    their pieces lie gapless from 0. Equal rows get different places. An
    empty table gives an empty result.
    """
    spark = pieces.sparkSession
    buckets = partitions_for(spark)
    keyed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(buckets)))
    # At most buckets x size rows, then at most size rows.
    per_bucket = materialize(keyed.groupBy("_bucket", "length").agg(F.count("*").alias("n")), "pack-counts")
    counts = {r["length"]: r["n"] for r in per_bucket.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    starts, base, times_in, offsets = [], [], [], []
    seen: Counter = Counter()
    sequence = 0
    for times, pattern in plan_patterns(counts, size):
        at = 0
        for n, k in pattern.items():
            starts.append(n << 44 | seen[n])
            base.append(sequence)
            times_in.append(k)
            offsets.append(at)
            seen[n] += times * k
            at += n * k
        sequence += times
    order = np.argsort(np.array(starts, dtype=np.int64), kind="stable")
    # A few thousand patterns of at most 45 different lengths each.
    places = spark.sparkContext.broadcast(
        [np.array(v, dtype=np.int64)[order] for v in (starts, base, times_in, offsets)]
    )
    before = per_bucket.select(
        "_bucket",
        "length",
        (F.sum("n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("n")).alias("_before"),
    )
    numbered = keyed.join(before, ["_bucket", "length"]).withColumn(
        "_rank",
        F.col("_before")
        + F.row_number().over(Window.partitionBy("_bucket", "length").orderBy("doc_id", "piece", "start"))
        - 1,
    )
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    out = numbered.select(*columns, "_rank")
    schema = ", ".join(f"`{c}` {out.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, base, times_in, offsets = places.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            key = length << 44 | batch.column("_rank").to_numpy()
            at = np.searchsorted(starts, key, side="right") - 1
            within = key - starts[at]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in columns),
                    pa.array(base[at] + within // times_in[at], pa.int64()),
                    pa.array(offsets[at] + within % times_in[at] * length, pa.int64()),
                ],
                names=[*columns, "sequence_id", "offset"],
            )

    return out.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_json: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Cut and pack all documents: one row per piece with doc_id, piece,
    start, length, ids_crc32, sequence_id, offset."""
    return pack(materialize(token_pieces(docs, tokenizer_json, size, end_id), "pack-pieces"), size)
