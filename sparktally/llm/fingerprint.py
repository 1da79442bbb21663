"""Order MinHash document fingerprints.

The k-mers of a text (k code points) are numbered by occurrence, so the third
"the " differs from the first. For each of ``HASHES`` permutations the
``PICKS`` numbered k-mers with the smallest permuted values are selected and
put back into text order, and the tuple of their k-mers is hashed to one slot
of the fingerprint. Two texts agree in a slot when they share the selected
k-mers *and* their order, so the share of equal slots falls with edit
distance, moved parts included, where a plain MinHash would not see a
reordering.

Texts are read once, in doc_id order inside a range of ids: the next document
of a row is the next row of the stream, and the first row of every range is
sent to the range before it too. Ranges come from approximate quantiles of
the ids, so no global sort and no window over all rows is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparktally.llm.common import materialize, mix64, no_collection, small_batches

KMER = 8
PICKS = 2
HASHES = 32
RANGE_BYTES = 24 << 20
RANGES = 4096
_M = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


class OrderMinHash:
    """Fingerprints of code-point sequences."""

    def __init__(self, kmer: int = KMER, picks: int = PICKS, hashes: int = HASHES, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.kmer, self.picks, self.hashes = kmer, picks, hashes
        self.mul = rng.integers(0, 1 << 31, hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.add = rng.integers(0, 1 << 32, hashes, dtype=np.uint32)

    def kmers(self, points: np.ndarray) -> np.ndarray:
        """64-bit hashes of the k-mers; a shorter text is one k-mer."""
        k = min(self.kmer, len(points))
        n = len(points) - k + 1
        x = points.astype(np.uint64)
        out = np.full(n, np.uint64(k))
        for j in range(k):
            out = out * _M + x[j : n + j]
        return mix64(out)

    @staticmethod
    def occurrences(kmers: np.ndarray) -> np.ndarray:
        """How many equal k-mers stand before each one."""
        n = len(kmers)
        place = np.arange(n, dtype=np.uint64)
        # Upper halves of the hashes with the place below: a plain sort puts
        # equal k-mers together in text order.
        order = np.sort((kmers & ~_LOW) | place)
        head = order >> np.uint64(32)
        new = np.empty(n, dtype=bool)
        new[0] = True
        np.not_equal(head[1:], head[:-1], out=new[1:])
        if new.all():
            return np.zeros(n, dtype=np.uint64)
        starts = np.flatnonzero(new)
        rank = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        out = np.empty(n, dtype=np.uint64)
        out[(order & _LOW).astype(np.int64)] = rank
        return out

    def fingerprint(self, points: np.ndarray) -> np.ndarray:
        """uint32 slots; the empty text has the slots of no k-mer (zeros)."""
        if not len(points):
            return np.zeros(self.hashes, dtype=np.uint32)
        kmers = self.kmers(points)
        numbered = (mix64(kmers + self.occurrences(kmers) * _M) >> np.uint64(32)).astype(np.uint32)
        picks = min(self.picks, len(kmers))
        chosen = np.empty((self.hashes, picks), dtype=np.int64)
        # Blocks of the text keep the permuted values inside the cache.
        best = np.full((self.hashes, picks), np.iinfo(np.uint64).max, dtype=np.uint64)
        rows = np.arange(self.hashes)
        for a in range(0, len(numbered), 4096):
            h = np.multiply.outer(self.mul, numbered[a : a + 4096])
            h += self.add[:, None]
            found = [best]
            for _ in range(min(picks, h.shape[1])):
                at = h.argmin(axis=1)
                low = h[rows, at].astype(np.uint64) << np.uint64(32) | (at + a).astype(np.uint64)
                found.append(low[:, None])
                h[rows, at] = np.uint32(0xFFFFFFFF)
            best = np.sort(np.concatenate(found, axis=1), axis=1)[:, :picks]
        chosen = np.sort((best & _LOW).astype(np.int64), axis=1)
        slot = np.full(self.hashes, np.uint64(picks))
        for j in range(picks):
            slot = mix64(slot * _M + kmers[chosen[:, j]])
        return (slot >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal slots."""
    return float((a == b).mean())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and fingerprint (hexadecimal slots) of every row; NULL text
    counts as empty, whose fingerprint is all zeros. Texts shorter than a
    k-mer are one k-mer. Other columns are ignored."""
    slim = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = OrderMinHash()
        for batch in small_batches(batches, "_text"):
            out = [hasher.fingerprint(code_points(t)).tobytes().hex() for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out, pa.string())], names=[*keep, "fingerprint"])

    return slim.mapInArrow(run, f"{schema}, fingerprint string")


def _ranged(slim: DataFrame) -> tuple[DataFrame, int]:
    """Rows with the number of their id range, and how many ranges there are:
    at most ``RANGES``, beyond which they grow (a range is streamed, not held).

    The bounds are literals of two levels, groups of bounds and bounds, so a
    row is compared with about twice the root of their number."""
    size = slim.agg(F.sum(F.octet_length("_text").cast("double")).alias("n")).first()["n"] or 0
    wanted = min(RANGES, max(1, int(-(-size // RANGE_BYTES))))
    cuts: list[int] = []
    if wanted > 1:
        at = [i / wanted for i in range(1, wanted)]
        cuts = sorted({int(c) for c in slim.approxQuantile("doc_id", at, 0.2 / wanted)})
    if not cuts:
        return slim.withColumn("part", F.lit(0)), 1
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    numbers = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    below = lambda bounds: F.size(F.filter(bounds, lambda c: c <= F.col("doc_id")))
    # Groups that begin at or below the id; all bounds of those before the
    # last one are below it too.
    begun = slim.withColumn("_begun", below(numbers([g[0] for g in groups])))
    inside = below(F.element_at(F.array(*map(numbers, groups)), F.greatest(F.lit(1), F.col("_begun"))))
    number = F.greatest(F.lit(0), F.col("_begun") - 1) * step + inside
    # NULL ids come first in ascending order.
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(number).cast("int")
    return begun.withColumn("part", part).drop("_begun"), len(cuts) + 1


def compare_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next for every row.

    The edited text has its last floor(n_chars / 4) code points replaced by
    the first as many (or all) of the next document's text in ascending
    doc_id; after the last comes the first, and a single row is its own next.
    NULL text counts as empty; NULL ids come first; rows of one doc_id are
    ordered by their text, so repeated rows follow each other. Other columns
    are ignored, whatever their names. No rows give no rows.
    """
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    ranged, parts = _ranged(slim)
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "_text")
    # One row per range: the first in order.
    firsts = materialize(
        ranged.groupBy("part").agg(F.min(order).alias("row")).select("part", "row.doc_id", F.col("row._text").alias("_text")), "omh-firsts"
    )
    # The first row of a range also ends the range before it; that of the
    # first one ends the last. One row per range is ordered.
    before = F.coalesce(F.lag("part").over(Window.orderBy("part")), F.max("part").over(Window.partitionBy()))
    extra = firsts.select("doc_id", "_text", before.cast("int").alias("part"), F.lit(1).alias("tail"))
    stream = (
        ranged.select("doc_id", "_text", "part", F.lit(0).alias("tail")).unionByName(extra)
        .repartitionByRange(parts, "part")
        .sortWithinPartitions("part", "tail", F.col("doc_id").asc_nulls_first(), "_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with no_collection():
            hasher = OrderMinHash()
            held: tuple | None = None  # (part, doc_id, points, fingerprint)
            for batch in small_batches(batches, "_text"):
                out: list[list] = [[] for _ in range(7)]
                rows = zip(*(batch.column(c).to_pylist() for c in ("part", "tail", "doc_id", "_text")))
                for part, tail, ident, body in rows:
                    points = code_points(body)
                    row = (part, ident, points, hasher.fingerprint(points))
                    if held is not None and held[0] == part:
                        _, own, mine, mark = held
                        cut = len(mine) // 4
                        edited = np.concatenate([mine[: len(mine) - cut], points[:cut]])
                        other = hasher.fingerprint(edited)
                        for column, value in zip(
                            out,
                            (
                                own,
                                len(mine),
                                hashlib.sha256(edited.tobytes().decode("utf-32-le").encode("utf-8")).hexdigest(),
                                mark.tobytes().hex(),
                                other.tobytes().hex(),
                                likeness(mark, other),
                                likeness(mark, row[3]),
                            ),
                        ):
                            column.append(value)
                    held = None if tail else row
                if out[0]:
                    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return stream.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
