"""Byte-level BPE encoding and decoding by monoid tree reduction.

The encodings of byte strings form a monoid: the identity is the empty list,
and ``join`` makes the encoding of x + y from those of x and y. A match of the
pre-tokenisation pattern is encoded as a balanced tree over its bytes: halves
are encoded recursively down to leaves of a few bytes, and neighbours are
joined upwards. Texts are the top of the tree: their matches never merge, so
there a join only concatenates. Decoding concatenates the token bytes up the
same tree.

When a join is certain. Greedy merging always takes the adjacent parts whose
joined bytes have the lowest rank, the leftmost on ties. Take a sequence of
tokens in which every two neighbours are, by themselves, the encoding of
their joint bytes. Follow greedy merging on the whole string up to the first
merge across a boundary of two neighbours: until then each step inside the two
is also the best one among the parts of the two alone, so merging the two
alone makes the same steps and then the same merge across the boundary - but
it makes none. So no boundary is ever crossed, each token is built as it is
alone, and the sequence is the encoding of the whole. The converse holds by
the same argument. Only the tokens at the seam are new neighbours, so ``join``
re-encodes a window around the seam and doubles it until the tokens at both of
its edges are such neighbours of the tokens outside: those are then final.

The operator is one ``mapInArrow`` over the scan: no shuffle, the ranks (a
fixed vocabulary file of a few megabytes) are sent to every worker, and the
caches are emptied when they hold a fixed number of entries; results do not
depend on that.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktally.llm.common import no_collection, small_batches

LEAF = 4  # bytes that are merged directly
SHORT = 48  # bytes up to which scanning all pairs beats a heap
WORDS = 400_000  # entries of a cache before it is emptied
NO_RANK = 1 << 40


def read_ranks(source: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file's content (base64, space, rank)."""
    pairs = (line.split() for line in source.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class TreeCoder:
    """Encoding and decoding of single matches."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary has no token for {len(missing)} of the 256 bytes")
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        # Two tokens -> None if they are the encoding of their joint bytes,
        # else that encoding; leaf bytes -> ids.
        self.pairs: dict[tuple[int, int], list[int] | None] = {}
        self.leaves: dict[bytes, list[int]] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Greedy merging of a whole byte string, no tree."""
        rank = self.ranks.get
        if len(piece) > SHORT:
            return self._merged_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        found = [rank(x + y, NO_RANK) for x, y in zip(parts, parts[1:])]
        while found:
            best = min(found)
            if best == NO_RANK:
                break
            at = found.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at < len(found):
                found[at] = rank(parts[at] + parts[at + 1], NO_RANK)
            if at:
                found[at - 1] = rank(parts[at - 1] + parts[at], NO_RANK)
        return [self.ranks[p] for p in parts]

    def _merged_long(self, piece: bytes) -> list[int]:
        """The same with a heap over a linked list of parts."""
        n, rank = len(piece), self.ranks.get
        end = list(range(1, n + 1))  # end of the part that begins here
        before = list(range(-1, n - 1))  # begin of the part before
        alive = [True] * n
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2], NO_RANK)) < NO_RANK]
        heapq.heapify(heap)
        while heap:
            _, a, b, stop = heapq.heappop(heap)
            if not alive[a] or end[a] != b or b == n or end[b] != stop:
                continue  # one of the two has changed since
            alive[b] = False
            end[a] = stop
            if stop < n:
                before[stop] = a
                if (r := rank(piece[a : end[stop]], NO_RANK)) < NO_RANK:
                    heapq.heappush(heap, (r, a, stop, end[stop]))
            if (left := before[a]) >= 0 and (r := rank(piece[left:stop], NO_RANK)) < NO_RANK:
                heapq.heappush(heap, (r, left, a, stop))
        out, a = [], 0
        while a < n:
            out.append(self.ranks[piece[a : end[a]]])
            a = end[a]
        return out

    def seam(self, left: int, right: int) -> list[int] | None:
        """None if two tokens are the encoding of their joint bytes, else
        that encoding."""
        try:
            return self.pairs[left, right]
        except KeyError:
            if len(self.pairs) >= WORDS:
                self.pairs.clear()
            of = self.bytes_of
            found = self.merged(of[left] + of[right])
            self.pairs[left, right] = found = None if found == [left, right] else found
            return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of x + y, from those of x and y."""
        if not left or not right:
            return left + right
        seam = self.seam(left[-1], right[0])
        if seam is None:
            return left + right
        reach = 1
        while True:
            a, b = len(left) - reach, reach
            if (a <= 0 or self.seam(left[a - 1], seam[0]) is None) and (b >= len(right) or self.seam(seam[-1], right[b]) is None):
                return left[: max(0, a)] + seam + right[b:]
            reach *= 2
            seam = self.merged(self.decode(left[-reach:] + right[:reach]))

    def encode(self, match: bytes) -> list[int]:
        """ids of one match: its own token if it has one, else the tree."""
        own = self.ranks.get(match)
        return [own] if own is not None else self.reduced(match)

    def reduced(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF:
            found = self.leaves.get(piece)
            if found is None:
                if len(self.leaves) >= WORDS:
                    self.leaves.clear()
                found = self.leaves[piece] = self.merged(piece)
            return found
        half = -(-len(piece) // (2 * LEAF)) * LEAF  # leaves begin at multiples of LEAF
        return self.join(self.reduced(piece[:half]), self.reduced(piece[half:]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])


class TextCoder:
    """Whole texts, through a cache of distinct matches. ``pack`` turns a
    match's ids and decoded bytes into the cached value."""

    def __init__(self, coder: TreeCoder, pattern: str, pack):
        self.coder, self.find, self.pack = coder, regex.compile(pattern).findall, pack
        self.cache: dict[str, object] = {}

    def values(self, texts: list[str]) -> Iterator[list]:
        """The packed values of the matches of each text, in order."""
        cache, coder = self.cache, self.coder
        for text in texts:
            matches = self.find(text)
            fresh = set(matches).difference(cache)
            if fresh and len(cache) + len(fresh) > WORDS:
                cache.clear()
                fresh = set(matches)
            for match in fresh:
                ids = coder.encode(match.encode("utf-8"))
                cache[match] = self.pack(ids, coder.decode(ids))
            yield list(map(cache.__getitem__, matches))


def _coded(docs: DataFrame, ranks: str, pattern: str, text: str, keep: tuple[str, ...], digests: bool) -> DataFrame:
    source = docs.sparkSession.sparkContext.broadcast(ranks)
    slim = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("_text"))
    fields = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in keep)
    extra = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with no_collection():
            pack = (lambda ids, raw: (len(ids), "".join([f",{i}" for i in ids]), raw)) if digests else (lambda ids, raw: (ids, raw))
            coder = TextCoder(TreeCoder(read_ranks(source.value)), pattern, pack)
            for batch in small_batches(batches, "_text"):
                kept = [batch.column(c) for c in keep]
                cols: list[list] = [[], [], []]
                for values in coder.values(batch.column("_text").to_pylist()):
                    if digests:
                        sizes, ids, raw = zip(*values) if values else ((), (), ())
                        cols[0].append(sum(sizes))
                        cols[1].append(hashlib.sha256("".join(ids)[1:].encode("ascii")).hexdigest())
                        cols[2].append(hashlib.sha256(b"".join(raw)).hexdigest())
                    else:
                        cols[0].append([i for ids, _ in values for i in ids])
                        cols[1].append(b"".join([raw for _, raw in values]))
                if digests:
                    made = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())]
                    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    made = [pa.array(cols[0], pa.list_(pa.int32())), pa.array(cols[1], pa.binary())]
                    names = ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=[*keep, *names])

    return slim.mapInArrow(run, f"{fields}, {extra}")


def encode_decode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: ``keep``, ids (array<int>), decoded (the bytes of those ids).

    ``ranks`` is the content of a rank file, ``pattern`` its pre-tokenisation
    pattern; each match is encoded separately, and text that no match covers
    has no ids. Special tokens are unknown: their strings are ordinary text.
    NULL text counts as empty (no ids, no bytes). Rows are kept one to one,
    repeated rows included; other columns are ignored, whatever their names.
    """
    return _coded(docs, ranks, pattern, text, keep, digests=False)


def encode_digests(docs: DataFrame, ranks: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As ``encode_decode``, with n_tokens, ids_sha256 (decimal ids joined by
    commas) and decoded_sha256 in place of the ids and the bytes."""
    return _coded(docs, ranks, pattern, text, keep, digests=True)
