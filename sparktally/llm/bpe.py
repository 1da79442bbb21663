"""BPE encoding and decoding by prefix-sharing trie traversal.

A byte-level BPE encoding has a local validity rule: a token sequence is the
encoding of its bytes exactly when every adjacent pair of tokens is itself
the encoding of the pair's bytes. So the encoding of a prefix is fully
described by its *last token* and the (shorter) prefix before that token.
Distinct words are inserted into a byte trie; a depth-first walk gives each
new node its last token from the states of its ancestors, and the encoding of
a prefix shared by many words is computed once. A word's ids are read off by
stepping back through the last tokens.

The operator is one ``mapInArrow`` over the scan: no shuffle, each worker
holds the vocabulary (a few megabytes, from one tokenizer file) and a trie
and word cache that are emptied when they reach a fixed number of entries, so
memory is bounded and results do not depend on the emptying.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktally.llm.common import no_collection, small_batches

# The byte-level pre-tokenisation pattern of the vocabulary.
PRETOKEN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_WORDS = 200_000
PAIRS = 400_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file: printable
    Latin-1 characters stand for themselves, the other bytes take code points
    from 256 upwards in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if chr(b) not in table]
    table.update({chr(256 + i): b for i, b in enumerate(hidden)})
    return table


class Vocabulary:
    """Token bytes, merge ranks and special tokens of a tokenizer file."""

    def __init__(self, source: str):
        spec = json.loads(source)
        table = byte_alphabet()
        raw = lambda s: bytes(table[c] for c in s)
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ", 1) for m in spec["model"]["merges"]]
        self.ranks = {(raw(x), raw(y)): r for r, (x, y) in enumerate(merges)}
        # How each token is made: (rank, left part, right part); bytes rank -1.
        self.made: dict[bytes, tuple[int, bytes, bytes]] = {}
        for (x, y), r in self.ranks.items():
            self.made.setdefault(x + y, (r, x, y))
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.bytes_of = [b""] * size
        for t, i in self.ids.items():
            self.bytes_of[i] = t
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode("utf-8")
        self.longest = max(map(len, self.ids))

    def merge(self, text: bytes) -> list[bytes]:
        """Plain greedy merging by rank; used to see which tokens stand for
        themselves."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(p, 1 << 40), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 40:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def adjacent(self, left: bytes, right: bytes) -> bool:
        """Whether the two tokens side by side are the encoding of their bytes.

        Undoes the merges that built the two tokens, latest first. At each
        step the parts that meet at the boundary must not form a merge that
        greedy merging would have done before the step just undone: lower
        rank, or equal rank and further left.
        """
        ranks, made = self.ranks, self.made
        none = (-1, b"", b"")
        limit = 1 << 40
        while True:
            if ranks.get((left, right), 1 << 40) < limit:
                return False
            a, b = made.get(left, none), made.get(right, none)
            if a[0] > b[0]:
                limit, left = a[0], a[2]
            elif b[0] >= 0:
                limit, right = b[0] + 1, b[1]
            else:
                return True


class TrieEncoder:
    """Encodes words by propagating last-token states down a byte trie.

    The distinct words, in byte order, are the trie's leaves in depth-first
    order: consecutive words share the path of their common prefix. The walk
    keeps only the current path as a stack holding, per prefix, the id of the
    last token of its encoding; stepping to the next word pops to the common
    prefix and computes states for the new nodes only, so the encoding of a
    shared prefix is computed once.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.pairs: dict[int, bool] = {}
        # Tokens that greedy merging builds from their own bytes; only these
        # can begin a word.
        self.whole = {t: i for t, i in vocab.ids.items() if len(t) == 1 or t in vocab.made}
        self.whole = {t: i for t, i in self.whole.items() if len(vocab.merge(t)) == 1}

    def _adjacent(self, left: int, right: int) -> bool:
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        of = self.vocab.bytes_of
        ok = self.pairs[left << 20 | right] = self.vocab.adjacent(of[left], of[right])
        return ok

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """ids of each word."""
        ids, whole, pairs, adjacent = self.vocab.ids.get, self.whole.get, self.pairs.get, self._adjacent
        size, longest = list(map(len, self.vocab.bytes_of)), self.vocab.longest
        out = {}
        stack = [-1]  # last token of each prefix of the current word
        before = b""
        for word in sorted(words):
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del stack[shared + 1 :]
            before = word
            for end in range(shared + 1, len(word) + 1):
                # One token fits; the parent's last token grown by this byte
                # and short tokens are the likely ones.
                up = stack[-1]
                grown = end - 1 - size[up] if up >= 0 else 0
                start = grown
                token = -1
                while True:
                    if start == 0:
                        token = whole(word[:end], -1)
                        if token >= 0:
                            break
                    else:
                        token = ids(word[start:end], -1)
                        if token >= 0:
                            left = stack[start]
                            ok = pairs(left << 20 | token)
                            if ok or (ok is None and adjacent(left, token)):
                                break
                    if start == grown:
                        start = end  # from here on: shortest first
                    start -= 1
                    if start == grown:
                        start -= 1
                    if start < 0 or end - start > longest:
                        raise ValueError("the vocabulary has no token for a byte")
                stack.append(token)
            found = []
            end = len(word)
            while end:
                token = stack[end]
                found.append(token)
                end -= size[token]
            found.reverse()
            out[word] = found
        return out


def _clean(part: str) -> bool:
    """Neither empty nor beginning or ending in white space (of any kind)."""
    return bool(part) and not part[0].isspace() and not part[-1].isspace()


class TextEncoder:
    """Whole texts to ids, through a cache keyed by space-separated pieces.

    A single space between two non-space characters always starts a
    pre-token, so such pieces encode independently; pieces touching other
    white space are joined and encoded as one unit. ``encode_many`` gives the
    ids of a list of units (strings with their leading space); ``pack`` turns
    ids into the cached value. ``pieces`` holds clean pieces (standing for a
    space and the piece), ``units`` any other unit. Each is a cache of two
    generations: when the young one is full it becomes the old one, and what
    is looked up in the old one moves to the young one.
    """

    def __init__(self, encode_many, pack, special: dict[str, int]):
        self.encode_many, self.pack = encode_many, pack
        self.pieces: dict[str, object] = {}
        self.old: dict[str, object] = {}
        self.units: dict[str, object] = {}
        self.special = {t: pack([i]) for t, i in special.items()}
        self.marks = tuple(special)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")").split if special else None

    def _segments(self, text: str) -> list[str]:
        return self.cut(text) if any(m in text for m in self.marks) else [text]

    @staticmethod
    def _joined(parts: list[str]) -> list[str]:
        """Units of a segment in which some piece touches other white space."""
        out = [parts[0]]
        before = _clean(parts[0])
        for p in parts[1:]:
            ok = _clean(p)
            if before and ok:
                out.append(" " + p)
            else:
                out[-1] += " " + p
            before = ok
        return [u for u in out if u]

    def encode(self, texts: list[str]) -> Iterator[list]:
        """The packed values of the units of each text, in order."""
        if len(self.pieces) > CACHE_WORDS:
            self.old, self.pieces = self.pieces, {}
        if len(self.units) > CACHE_WORDS // 4:
            self.units.clear()
        pieces, units, old = self.pieces, self.units, self.old
        plans: list[list] = []  # per text: (cache, keys) runs
        new_pieces: set[str] = set()
        new_units: set[str] = set()
        for text in texts:
            plan: list = []
            for k, segment in enumerate(self._segments(text)):
                if k % 2:
                    plan.append((self.special, [segment]))
                    continue
                parts = segment.split(" ")
                first, rest = parts[0], parts[1:]
                fresh = set(rest).difference(pieces, new_pieces)
                if _clean(first) and all(map(_clean, fresh)):
                    plan.append((units, [first]))
                    plan.append((pieces, rest))
                    new_units.add(first)
                    new_pieces |= fresh
                else:
                    joined = self._joined(parts)
                    plan.append((units, joined))
                    new_units.update(joined)
            plans.append(plan)
        moved = old.keys() & new_pieces
        pieces.update(zip(moved, map(old.__getitem__, moved)))
        new_pieces -= moved
        new_units.difference_update(units)
        keys = [*new_pieces, *new_units]
        if keys:
            values = map(self.pack, self.encode_many([" " + p for p in new_pieces] + [*new_units]))
            made = list(zip(keys, values))
            pieces.update(made[: len(new_pieces)])
            units.update(made[len(new_pieces) :])
        for plan in plans:
            out: list = []
            for cache, run in plan:
                out += map(cache.__getitem__, run)
            yield out


def trie_units(vocab: Vocabulary):
    """``encode_many`` by the trie: units are pre-tokenised and the distinct
    words of the whole list go through the trie together."""
    trie, find = TrieEncoder(vocab), regex.compile(PRETOKEN_PATTERN).findall

    def many(units: list[str]) -> list[list[int]]:
        # A space and letters are one pre-token.
        cut = [[u] if u[1:].isalpha() and u[:1] == " " else find(u) for u in units]
        words = {w for found in cut for w in found}
        ids = trie.encode_words(dict.fromkeys(map(str.encode, words)))
        of = ids.__getitem__
        return [of(c[0].encode()) if len(c) == 1 else [i for w in c for i in of(w.encode())] for c in cut]

    return many


def encode_decode(docs: DataFrame, tokenizer_json: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: ``keep``, ids (array<int>), decoded (the text of those ids).

    ``tokenizer_json`` is the content of the tokenizer file. NULL text counts
    as empty (no ids, empty decoded text); special-token strings in a text
    become their ids. Rows are kept one to one, repeated rows included; other
    columns are ignored, whatever their names.
    """
    return _encoded(docs, tokenizer_json, text, keep, digests=False)


def encode_digests(docs: DataFrame, tokenizer_json: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As ``encode_decode``, with n_tokens, ids_sha256 (ids as little-endian
    unsigned 32-bit integers) and decoded_sha256 (UTF-8) in place of the ids
    and the text."""
    return _encoded(docs, tokenizer_json, text, keep, digests=True)


def _encoded(docs: DataFrame, tokenizer_json: str, text: str, keep: tuple[str, ...], digests: bool) -> DataFrame:
    source = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    slim = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("_text"))
    fields = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in keep)
    extra = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with no_collection():
            vocab = Vocabulary(source.value)
            of = vocab.bytes_of

            def pack(ids: list[int]) -> tuple[bytes, bytes]:
                return array("I", ids).tobytes(), b"".join([of[i] for i in ids])

            encoder = TextEncoder(trie_units(vocab), pack, vocab.special)
            for batch in small_batches(batches, "_text"):
                cols: list[list] = [[], [], []]
                for units in encoder.encode(batch.column("_text").to_pylist()):
                    ids = b"".join([u[0] for u in units])
                    decoded = b"".join([u[1] for u in units]).decode("utf-8", "replace")
                    if digests:
                        cols[0].append(len(ids) // 4)
                        cols[1].append(hashlib.sha256(ids).hexdigest())
                        cols[2].append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                    else:
                        cols[0].append(memoryview(ids).cast("I").tolist())
                        cols[1].append(decoded)
                kept = [batch.column(c) for c in keep]
                if digests:
                    made = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())]
                    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    made = [pa.array(cols[0], pa.list_(pa.int32())), pa.array(cols[1], pa.string())]
                    names = ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=[*keep, *names])

    return slim.mapInArrow(run, f"{fields}, {extra}")
