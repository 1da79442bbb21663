"""Cross-tokenizer alignment through tokenizer spans.

A text is encoded by two tokenizers: a byte-level BPE (A) over a space and the
text, and a sentencepiece model (B), which adds that space itself. The
character offsets of A and the spans of B's proto are the coarse cuts: a
token whose span ends where the next one begins ends at that
character. Tokens that share a character (parts of a multi-byte one) or are
byte fallbacks have no end of their own in the spans; theirs follow from the
decoded bytes. Byte offsets where tokens of both end cut the tokens into
groups, and the two tokens that end a group are linked.

Texts are encoded in segments: a run of spaces and what follows it up to the
next space, a word of Latin letters apart from the mark behind it and what
follows that. No token of either tokenizer holds a space after another
character (``segmentable`` verifies it for B's pieces; A's pattern allows a
space only in front), and neither looks further than the next character; A's
pattern ends a word before a mark, and marks that a piece of B holds behind a
letter are not cut at (``segments``). So
the segments of a text encode as they do inside it, and the end of a segment
is always a cut. Distinct segments are encoded once for each filling of a
cache of bounded size, many of them in a row as one text.

Counts of linked pairs cover the whole corpus. A first pass encodes and writes
each text's links to a table in the shared scratch folder, in blocks of
bounded size; the counts are summed with partial aggregates, each block asks
for the distinct pairs it holds, and the answers meet the block's texts by
block number. A pair that every text holds is one row per block.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktally.llm.bpe import byte_alphabet
from sparktally.llm.common import list_array, materialize, no_collection, small_batches

LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"  # of words that are cut off from the marks behind them
MARKS = ",.;:!?)"
SEGMENTS = 400_000  # entries of the cache before it is emptied
CHUNK = 1 << 15  # characters, about, of segments encoded together
BLOCK_BYTES = 8 << 20
SPACE = "▁"  # the stand-in of a space in sentencepiece models
WORD = " a"
SHIFT = 1 << 32  # a pair of ids as one number: a * SHIFT + b


class ByteLevel:
    """Ids, character offsets and token bytes of a byte-level BPE file."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.encode_special_tokens = True  # their strings are plain text
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        table = byte_alphabet()
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = [b""] * (1 + max(vocab.values()))
        for token, i in vocab.items():
            # A special token's own entry may not be byte-level; no text has it.
            self.bytes_of[i] = bytes(table[c] for c in token) if all(c in table for c in token) else b""

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """ids, and begins and ends of their spans in characters."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        ids = found.ids
        spans = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(ids))
        return ids, spans[::2], spans[1::2]


class Pieces:
    """Ids, spans and token bytes of a sentencepiece model, for texts that
    begin with the space that it adds."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.model.get_piece_size()
        self.names = [self.model.id_to_piece(i) for i in range(n)]
        self.fallback = np.array([self.model.is_byte(i) for i in range(n)])
        self.bytes_of = [
            bytes([int(p[3:-1], 16)]) if byte else p.replace(SPACE, " ").encode("utf-8") for p, byte in zip(self.names, self.fallback)
        ]

    def segmentable(self) -> bool:
        """No piece holds a space after another character."""
        return not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.names)

    def segments(self) -> re.Pattern:
        """Pattern of the segments of a text with its leading space."""
        marks = "".join(m for m in MARKS if not any(re.search(f"[{LETTERS}]{re.escape(m)}", p) for p in self.names))
        words = f" [{LETTERS}]+(?=[{marks}])|[{marks}][^ ]*(?: +\\Z)?|" if marks else ""
        return re.compile(words + r" +[^ ]+(?: +\Z)?| +\Z")

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """ids, and begins and ends of their spans in bytes."""
        pieces = self.model.encode(text[1:], return_type="proto").pieces
        ids = [p.id for p in pieces]
        # The spans leave out the space that the model adds, and follow one
        # another; only byte fallbacks have empty ones.
        ends = np.array([p.end for p in pieces], dtype=np.int64) + 1
        return ids, np.concatenate([[0], ends[:-1]]), ends


def byte_ends(begins: np.ndarray, ends: np.ndarray, sizes: np.ndarray, fallback: np.ndarray) -> np.ndarray:
    """The byte offset at which every token ends: its span's end where the
    next span begins there, else that of the decoded bytes up to it.

    ``begins`` and ``ends`` are spans in bytes, ``sizes`` the numbers of
    decoded bytes, ``fallback`` marks byte-fallback tokens."""
    whole = (begins < ends) & ~fallback
    whole[:-1] &= ends[:-1] == begins[1:]
    return ends if whole.all() else np.where(whole, ends, np.cumsum(sizes))


class Aligner:
    """Groups of segments by two tokenizers."""

    def __init__(self, a: ByteLevel, b: Pieces):
        if not b.segmentable():
            raise ValueError("a piece with a space after another character: texts cannot be encoded in segments")
        self.a, self.b = a, b
        self.cut = b.segments().findall
        self.sizes = [np.array(list(map(len, t.bytes_of)), dtype=np.int64) for t in (a, b)]
        # An id as text, in front of another one of its side and at the end.
        self.inner, self.last_a, self.last_b = (
            [f"{i}{mark}" for i in range(max(map(len, (a.bytes_of, b.bytes_of))))] for mark in ",|;"
        )
        self._forget()

    def _forget(self) -> None:
        """Segments by number: their groups as text; tokens of A and of B,
        groups, bytes; where their linked pairs and cuts begin. Number 0 is a
        segment whose tokens are not its bytes."""
        self.cache: dict[str, int] = {}
        self.shown: list[str] = [""]
        self.sizes_of = np.zeros((1, 4), dtype=np.int64)
        self.begin = np.zeros(2, dtype=np.int64)
        self.pairs, self.cuts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def aligned(self, wanted: list[str]) -> tuple[list[str], list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Segments encoded as one text and cut again: those whose tokens are
        their bytes, their groups as text, their sizes (tokens of A and of B,
        groups, bytes), and the linked pairs and the cuts of all groups. A
        segment without a space is encoded behind a word, as it stands."""
        segments = [part for s in wanted for part in ((s,) if s[0] == " " else (WORD, s))]
        text = "".join(segments)
        raw = text.encode("utf-8")
        (ids_a, begins_a, ends_a), (ids_b, begins_b, ends_b) = self.a.encode(text), self.b.encode(text)
        of_a, of_b = self.a.bytes_of, self.b.bytes_of
        if b"".join([of_a[i] for i in ids_a]) != raw or b"".join([of_b[i] for i in ids_b]) != raw:
            half = len(wanted) // 2
            none = np.zeros(0, dtype=np.int64)
            if not half:
                return [], [], none.reshape(0, 4), none, none
            one, two = self.aligned(wanted[:half]), self.aligned(wanted[half:])
            return one[0] + two[0], one[1] + two[1], *(np.concatenate(x) for x in zip(one[2:], two[2:]))
        sizes = np.array([len(s) for s in segments])
        if len(raw) != len(text):
            # Byte offset of every character: the bytes that begin one.
            at = np.append(np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80), len(raw))
            begins_a, ends_a = at[begins_a], at[ends_a]
            sizes = np.diff(at[np.cumsum(sizes)], prepend=0)
        a, b = np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)
        ends_a = byte_ends(begins_a, ends_a, self.sizes[0][a], np.zeros(len(a), dtype=bool))
        ends_b = byte_ends(begins_b, ends_b, self.sizes[1][b], self.b.fallback[b])

        cuts, last_a, last_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        marks = []  # the text of every token, with the mark behind it
        for ids, last, closing in ((ids_a, last_a, self.last_a), (ids_b, last_b, self.last_b)):
            shown = [self.inner[i] for i in ids]
            for k in last.tolist():
                shown[k] = closing[ids[k]]
            marks += shown
        # Tokens of A and then of B, group by group.
        group = np.concatenate([np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)])
        shown = [marks[k] for k in np.argsort(group, kind="stable").tolist()]

        # Where each segment ends, in tokens and in groups.
        stops = np.cumsum(sizes)
        to = np.searchsorted(cuts, stops, side="right")
        if (cuts[to - 1] != stops).any():
            raise ValueError("a segment does not end with tokens of both sides")
        to_a, to_b = last_a[to - 1] + 1, last_b[to - 1] + 1
        counts = np.stack([np.diff(x, prepend=0) for x in (to_a, to_b, to)] + [sizes], axis=1)
        ends = (to_a + to_b).tolist()
        texts = ["".join(shown[i:j])[:-1] for i, j in zip([0, *ends], ends)]
        pairs, within = a[last_a] * SHIFT + b[last_b], cuts - np.repeat(stops - sizes, counts[:, 2])
        if len(segments) > len(wanted):  # leave the words out
            lead = np.zeros(len(segments), dtype=bool)
            lead[np.flatnonzero([s[0] != " " for s in segments]) - 1] = True
            groups = np.repeat(~lead, counts[:, 2])
            texts = [t for t, out in zip(texts, lead.tolist()) if not out]
            counts, pairs, within = counts[~lead], pairs[groups], within[groups]
        return wanted, texts, counts, pairs, within

    def _learn(self, fresh: set[str]) -> None:
        """Encode distinct segments: plain ones many at a time, those with
        spaces but the first one by themselves."""
        rows = [[s] for s in fresh if " " in s[1:]]
        plain = [s for s in fresh if " " not in s[1:]]
        step = max(1, CHUNK // 10)
        rows += [plain[i : i + step] for i in range(0, len(plain), step)]
        self.cache.update(dict.fromkeys(fresh, 0))
        learnt = [self.aligned(row) for row in rows]
        for segments, texts, *_ in learnt:
            self.cache.update(zip(segments, range(len(self.shown), len(self.shown) + len(texts))))
            self.shown += texts
        self.sizes_of, self.pairs, self.cuts = (
            np.concatenate([old, *(x[k] for x in learnt)]) for k, old in ((2, self.sizes_of), (3, self.pairs), (4, self.cuts))
        )
        self.begin = np.cumsum(self.sizes_of[:, 2]) - self.sizes_of[:, 2]

    def texts(self, texts: list[str]) -> "Aligned":
        """The alignment of texts; a text has no tokens if it is empty or the
        tokens of either tokenizer are not the bytes of a space and the text."""
        cut = [self.cut(" " + t) if t else [] for t in texts]
        fresh = set().union(*cut).difference(self.cache)
        if fresh and len(self.cache) + len(fresh) > SEGMENTS:
            self._forget()
            fresh = set().union(*cut)
        if fresh:
            self._learn(fresh)
        found = [list(map(self.cache.__getitem__, segments)) for segments in cut]
        return Aligned(self, [[] if 0 in numbers else numbers for numbers in found])


class Aligned:
    """Per text: groups (as text), sizes (tokens of A and of B, groups), and,
    as slices ``spans`` of flat arrays, linked pairs and cuts."""

    def __init__(self, known: Aligner, found: list[list[int]]):
        self.groups = [";".join(map(known.shown.__getitem__, numbers)) for numbers in found]
        lengths = np.array(list(map(len, found)), dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(found), np.int64, lengths.sum())
        ends = np.cumsum(lengths)
        sums = np.zeros((len(flat) + 1, 4), dtype=np.int64)
        np.cumsum(known.sizes_of[flat], axis=0, out=sums[1:])
        self.sizes = (sums[ends] - sums[ends - lengths])[:, :3]
        self.spans = [slice(a, b) for a, b in zip(sums[ends - lengths, 2].tolist(), sums[ends, 2].tolist())]
        groups = known.sizes_of[flat, 2]
        at = np.repeat(known.begin[flat] - sums[:-1, 2], groups) + np.arange(sums[-1, 2])
        self.pairs = known.pairs[at]
        # Bytes of the text's segments before each one.
        offset = sums[:-1, 3] - np.repeat(sums[ends - lengths, 3], lengths)
        self.cuts = known.cuts[at] + np.repeat(offset, groups)


_LINKED = "block long, pairs array<long>, times array<int>"


def _encoded(docs: DataFrame, a_source: str, b_model: bytes, text: str, keep: tuple[str, ...], digests: bool) -> DataFrame:
    """``keep``, the alignment's columns, and the text's distinct links with
    their numbers, in blocks of texts."""
    sent = docs.sparkSession.sparkContext.broadcast((a_source, b_model))
    slim = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.coalesce(F.col(text), F.lit("")).alias("_text"))
    fields = ", ".join(f"k{i} {slim.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep)))
    made = "n_a long, n_b long, n_groups long, " + ("groups_sha256 string" if digests else "groups string, cuts array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        with no_collection():
            aligner = Aligner(ByteLevel(sent.value[0]), Pieces(sent.value[1]))
            first = TaskContext.get().partitionId() << 32
            filled = 0
            for batch in small_batches(batches, "_text"):
                found = aligner.texts(batch.column("_text").to_pylist())
                distinct = [np.unique(found.pairs[span], return_counts=True) for span in found.spans]
                sizes = [len(d[0]) for d in distinct]
                links = [list_array(np.concatenate([d[k] for d in distinct]), sizes, kind) for k, kind in ((0, pa.int64()), (1, pa.int32()))]
                block = pa.array(np.full(len(sizes), first + filled // BLOCK_BYTES), pa.int64())
                filled += batch.column("_text").nbytes
                numbers = [pa.array(np.ascontiguousarray(c)) for c in found.sizes.T]
                if digests:
                    shown = [pa.array([hashlib.sha256(g.encode("ascii")).hexdigest() if g else g for g in found.groups], pa.string())]
                else:
                    shown = [pa.array(found.groups, pa.string()), list_array(found.cuts, found.sizes[:, 2])]
                names = ["n_a", "n_b", "n_groups", "groups_sha256"] if digests else ["n_a", "n_b", "n_groups", "groups", "cuts"]
                kept = [batch.column(f"k{i}") for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *numbers, *shown, block, *links],
                    names=[*[f"k{i}" for i in range(len(keep))], *names, "block", "pairs", "times"],
                )

    return slim.mapInArrow(run, ", ".join(filter(None, [fields, made, _LINKED])))


def link_counts(linked: DataFrame) -> DataFrame:
    """(pair, count, best): how many links hold each pair of ids, and whether
    no pair of the same B id is held more often."""
    counts = materialize(
        linked.select(F.explode(F.arrays_zip("pairs", "times")).alias("l"))
        .groupBy(F.col("l.pairs").alias("pair")).agg(F.sum("l.times").alias("count")),
        "align-counts",
    )
    highest = counts.groupBy(F.pmod("pair", F.lit(SHIFT)).alias("b")).agg(F.max("count").alias("highest"))
    return (
        counts.withColumn("b", F.pmod("pair", F.lit(SHIFT)))
        .join(highest, "b")
        .select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    )


def _sums(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """The texts of a block with n_best and count_sum, from the counts of the
    block's pairs."""
    order = np.argsort(answers.column("pair").to_numpy())
    known = answers.column("pair").to_numpy()[order]
    count, best = (answers.column(c).to_numpy()[order] for c in ("count", "best"))
    texts = texts.combine_chunks()
    pairs, times = (texts.column(c).combine_chunks() for c in ("pairs", "times"))
    sizes = np.diff(pairs.offsets.to_numpy())
    row = np.repeat(np.arange(len(sizes)), sizes)
    flat, often = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    at = np.searchsorted(known, flat)
    if len(flat) and not (len(known) and (known[np.minimum(at, len(known) - 1)] == flat).all()):
        raise ValueError("a block's pairs are not all counted")
    sums = []
    for value in (best, count):
        out = np.zeros(len(sizes), dtype=np.int64)
        if len(flat):
            np.add.at(out, row, often * value[at].astype(np.int64))
        sums.append(pa.array(out))
    kept = [c for c in texts.column_names if c not in ("block", "pairs", "times")]
    return texts.select(kept).append_column("n_best", sums[0]).append_column("count_sum", sums[1])


def align(
    docs: DataFrame, a_source: str, b_model: bytes, text: str = "text", keep: tuple[str, ...] = ("doc_id",), digests: bool = False
) -> DataFrame:
    """Per row: ``keep``, n_a and n_b (tokens), n_groups, groups
    (``a1,a2|b1;a3|b2``: ids in order), cuts (the byte offsets in a space and
    the text at which groups end), n_links, n_best (links whose count is the
    highest of their B id) and count_sum (over links).

    ``a_source`` is the content of a byte-level BPE file, ``b_model`` of a
    sentencepiece model. With ``digests``, groups_sha256 takes the place of
    groups and cuts. Texts that are NULL or empty or that the tokens of one
    tokenizer do not give back (spaces dropped or marks read as spaces) have no tokens: zeros
    and ''. Every row is counted and returned, repeated rows included; other
    columns are ignored, whatever their names.
    """
    linked = materialize(_encoded(docs, a_source, b_model, text, keep, digests), "align-links")
    asked = linked.select(F.col("block").alias("asking"), F.explode("pairs").alias("pair")).distinct()
    answers = asked.join(link_counts(linked), "pair").select("asking", "pair", "count", "best")
    fields = [f for f in linked.schema.fields if f.name not in ("block", "pairs", "times")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", n_best long, count_sum long"
    done = linked.groupBy("block").cogroup(answers.groupBy("asking")).applyInArrow(_sums, schema)
    shown = ["groups_sha256"] if digests else ["groups", "cuts"]
    return done.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", *shown,
    )
