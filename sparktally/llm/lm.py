"""Language-model scoring with a weighted backoff automaton.

Smoothed n-grams (up to three words) become an automaton. A state is a context
that is followed by kept n-grams, the root is the empty one. An arc of a state
carries the probability of a word after that context and leads to the longest
context that the words read so far end with; a failure arc carries the share
that the context's arcs have left and leads to the context without its first
word. Reading a word takes the state's arc for it, or follows failure arcs
until a state has one (the root has one for every word). One traversal from
left to right carries the state and adds up log-probabilities.

- Smoothing: absolute discounting, interpolated. What is taken from the
  unigrams goes to one unknown word. Every word, bigram and trigram of the
  training texts is counted exactly; a bigram or trigram is kept from ``LEAST``
  occurrences, at every size of the corpus.
- Texts are tokenised once, into blocks of bounded size that follow the input
  partitions (no shuffle), written to the shared scratch folder. A block gets
  only the states and arcs that its own texts can reach: there is no automaton
  of the whole corpus, on the driver or in any task.
- Counts meet by key. A block sends its distinct keys (hashes of n-grams), in
  order and packed, to the tasks that own their ranges; an owner adds up what
  all blocks sent and answers each block in the order of its keys. This is
  done three times: words and bigrams; trigrams whose two bigrams are both
  kept (others cannot be), and per word what its kept bigrams sum up to; per
  bigram what its kept trigrams sum up to. Such sums are taken by the block
  that an owner names as the first holder of an n-gram, so they count every
  n-gram once. A frequent word or context is one key, which a block sends
  once: no key gathers more than one entry from each block.
- A long text is walked in lanes of ``LANE`` words side by side. A state knows
  no more than the last two words, so a lane that reads the two words before
  it from the root is in the state of the traversal of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktally.llm.common import crc_mod, grouped, materialize, mix64, ship, shipped, small_batches
from sparktally.llm.shingles import hash_words, words_of

LEAST = 2  # occurrences of a kept bigram or trigram
DISCOUNT = 0.5
BLOCK_BYTES = 4 << 20  # text of a block
PART_KEYS = 2 << 20  # tokens of the corpus for each owner of a range of keys
LANE = 256  # words walked one after another
START, END = 1, 2  # marks in the place of word hashes
HOLD_OUT = 10


def _sequence(text: str) -> np.ndarray:
    """START, the words' hashes, END."""
    words = words_of(text)
    out = np.empty(len(words) + 2, dtype=np.uint64)
    out[0], out[-1] = START, END
    out[1:-1] = hash_words(words)
    return out


def _packed(column: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes, as many as the largest
    number needs; in front their number and how many numbers there are."""
    column = np.ascontiguousarray(column).astype("<u8", copy=False)
    width = max(1, (int(column.max(initial=0)).bit_length() + 7) // 8)
    planes = column.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return bytes([width]) + len(column).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _length(raw: bytes) -> int:
    return int.from_bytes(raw[1:9], "little")


def _numbers(raw: bytes) -> np.ndarray:
    n, width = _length(raw), raw[0]
    out = np.zeros((n, 8), dtype=np.uint8)
    if n:
        planes = pa.Codec("zstd", 1).decompress(raw[9:], decompressed_size=n * width, asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def _packed_sorted(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))


# -- blocks of tokens ----------------------------------------------------------


def token_blocks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per block: block, doc_ids, held_out, tokens (their number with
    the marks), lengths, words (distinct hashes, most frequent first), places
    (of every token in ``words``)."""
    slim = docs.select(
        F.col(doc_id).alias("doc_id"),
        (crc_mod(doc_id, HOLD_OUT) == 0).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    kind = slim.schema["doc_id"].dataType.simpleString()

    def row(block: int, ids: list, kind: pa.DataType, held: list, seqs: list[np.ndarray]) -> pa.RecordBatch:
        joined = np.concatenate(seqs)
        words, place, often = np.unique(joined, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()), pa.array([ids], pa.list_(kind)), pa.array([held], pa.list_(pa.bool_())),
                pa.array([len(joined)], pa.int64()), pa.array([_packed(np.array([len(s) for s in seqs]))], pa.binary()),
                pa.array([words[order].tobytes()], pa.binary()),
                pa.array([_packed(rank[place])], pa.binary()),
            ],
            names=["block", "doc_ids", "held_out", "tokens", "lengths", "words", "places"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, held, seqs, size, id_type = [], [], [], 0, None
        for batch in small_batches(batches, "_text"):
            id_type = batch.schema.field("doc_id").type
            for i, out, content in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "_text"))):
                ids.append(i)
                held.append(out)
                seqs.append(_sequence(content))
                size += len(content) + 1
                if size >= BLOCK_BYTES:
                    yield row(block, ids, id_type, held, seqs)
                    block += 1
                    ids, held, seqs, size = [], [], [], 0
        if seqs:
            yield row(block, ids, id_type, held, seqs)

    return slim.mapInArrow(
        run, f"block long, doc_ids array<{kind}>, held_out array<boolean>, tokens long, lengths binary, words binary, places binary"
    )


class Block:
    """The texts of a block: words (hashes, ascending), the place of every
    token in them, and the distinct bigrams in the order of their keys."""

    def __init__(self, row: pa.Table):
        value = lambda c: row.column(c)[0].as_py()
        self.lengths = _numbers(value("lengths")).astype(np.int64)
        self.held = np.array(value("held_out"), dtype=bool)
        n = value("tokens")
        words = np.frombuffer(value("words"), dtype=np.uint64)
        order = np.argsort(words)
        self.words = words[order]
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        self.tokens = rank[_numbers(value("places")).view(np.int64)]
        self.train = np.repeat(~self.held, self.lengths)
        self.starts = np.cumsum(self.lengths) - self.lengths

        # Bigrams end at every token but the first of a text.
        within = np.ones(n, dtype=bool)
        within[self.starts] = False
        self.at2 = np.flatnonzero(within)
        within[self.starts + 1] = False
        self.at3 = np.flatnonzero(within)
        pair = self.tokens[self.at2 - 1] * len(self.words) + self.tokens[self.at2]
        pair, place = np.unique(pair, return_inverse=True)
        first, second = np.divmod(pair, len(self.words))
        key = _joint(self.words[first], self.words[second])
        order = np.argsort(key)
        self.first, self.second, self.key2 = first[order], second[order], key[order]
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        self.bigram = np.full(n, -1, dtype=np.int64)  # that ends at each token
        self.bigram[self.at2] = rank[place]

    def count(self, of: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """How often each value occurs at training positions."""
        return np.bincount(of[self.train[at]], minlength=size)

    def trigrams(self, kept2: np.ndarray) -> None:
        """Distinct trigrams made of two kept bigrams, in the order of keys."""
        parent, tail = self.bigram[self.at3 - 1], self.bigram[self.at3]
        both = kept2[parent] & kept2[tail]
        at = self.at3[both]
        joint = parent[both] * len(self.words) + self.tokens[at]
        joint, where, place = np.unique(joint, return_index=True, return_inverse=True)
        parent, third = np.divmod(joint, max(1, len(self.words)))
        key = _joint(self.key2[parent], self.words[third])
        order = np.argsort(key)
        self.parent, self.key3 = parent[order], key[order]
        self.tail = tail[both][where][order]  # the bigram of the last two words
        self.own3 = self.count(place, at, len(key))[order]


def _joint(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit keys of sequences, from those without the last word."""
    key = mix64((left ^ np.uint64(0x2545F4914F6CDD1D)) * np.uint64(0x9E3779B97F4A7C15))
    return mix64((key ^ right) * np.uint64(0xD6E8FEB86659FD93))


# -- sums of keys over blocks --------------------------------------------------
#
# A round has one or two kinds of keys, each with a number of values. A message
# (part, block, keys, values) holds, per kind, what one block sends to one
# owner; there are at most as many messages as keys.

_MESSAGE = "part int, block long, keys array<binary>, values array<binary>"
_ANSWER = "block long, part int, totals array<binary>, firsts array<binary>, stats array<long>"
_BINARIES = pa.list_(pa.binary())


def _owner(keys: np.ndarray, parts: int) -> np.ndarray:
    """Owners have equal ranges of keys."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _messages(block: int, kinds: list[tuple[np.ndarray, list[np.ndarray]]], parts: int) -> Iterator[pa.RecordBatch]:
    """``kinds``: ascending keys and their values."""
    owners = [_owner(keys, parts) for keys, _ in kinds]
    for part in np.unique(np.concatenate(owners)).tolist():
        spans = [slice(*np.searchsorted(o, [part, part + 1]).tolist()) for o in owners]
        keys = [_packed_sorted(k[s]) for (k, _), s in zip(kinds, spans)]
        values = [_packed(v[s]) for (_, vs), s in zip(kinds, spans) for v in vs]
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([keys], _BINARIES), pa.array([values], _BINARIES)],
            names=["part", "block", "keys", "values"],
        )


def _answered(messages: DataFrame, sizes: list[int], parts: int, name: str) -> DataFrame:
    """The sums of all blocks, for every block in the order of its keys, and
    whether the block is the first that sent the key. ``sizes``: the number of
    values of each kind. Rows without a block hold numbers about the first
    kind: the sum of its totals, how many there are, of one and of two, the
    START mark left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in grouped(batches, "part"):
            table = table.sort_by("block")
            blocks = table.column("block").to_pylist()
            keys, values = (table.column(c).to_pylist() for c in ("keys", "values"))
            totals: list[list[bytes]] = [[] for _ in blocks]
            firsts: list[list[bytes]] = [[] for _ in blocks]
            slot = 0
            for kind, width in enumerate(sizes):
                sent = [np.cumsum(_numbers(k[kind]), dtype=np.uint64) for k in keys]
                ends = np.cumsum([len(s) for s in sent])
                distinct, at, place = np.unique(np.concatenate(sent), return_index=True, return_inverse=True)
                first = np.zeros(len(place), dtype=bool)
                first[at] = True
                for i, (a, b) in enumerate(zip(ends - [len(s) for s in sent], ends)):
                    firsts[i].append(np.packbits(first[a:b]).tobytes())
                for v in range(slot, slot + width):
                    given = np.concatenate([_numbers(x[v]) for x in values])
                    total = np.zeros(len(distinct), dtype=np.int64)
                    np.add.at(total, place, given.astype(np.int64))
                    for i, (a, b) in enumerate(zip(ends - [len(s) for s in sent], ends)):
                        totals[i].append(_packed(total[place[a:b]]))
                    if v == 0:
                        counted = total[(distinct != START) & (total > 0)]
                        stats = [int(counted.sum()), len(counted), int((counted == 1).sum()), int((counted == 2).sum())]
                slot += width
            rows = [[None, *blocks], [part] * (len(blocks) + 1), [None, *totals], [None, *firsts], [stats, *[None] * len(blocks)]]
            kinds = [pa.int64(), pa.int32(), _BINARIES, _BINARIES, pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, kinds)], names=["block", "part", "totals", "firsts", "stats"])

    owned = messages.repartition(parts, "part").sortWithinPartitions("part")
    return materialize(owned.mapInArrow(run, _ANSWER), name)


def _read(answers: pa.Table, sizes: list[int]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Totals of all values and the marks of first holders, of all kinds, in
    the order in which the block sent its keys."""
    answers = answers.sort_by("part")
    given, marked = (answers.column(c).to_pylist() for c in ("totals", "firsts"))
    totals = [np.concatenate([np.zeros(0, np.int64), *(_numbers(g[v]).astype(np.int64) for g in given)]) for v in range(sum(sizes))]
    firsts = []
    for kind, v in enumerate(np.cumsum(sizes) - sizes):
        bits = [np.unpackbits(np.frombuffer(m[kind], np.uint8), count=_length(g[v])) for g, m in zip(given, marked)]
        firsts.append(np.concatenate([np.zeros(0, np.uint8), *bits]).astype(bool))
    return totals, firsts


ROUNDS = {"words": [1, 1], "trigrams": [2, 1], "contexts": [2]}


def _first_messages(blocks: DataFrame, parts: int) -> DataFrame:
    """Words and bigrams with their training counts; those of held-out texts
    alone with 0, to learn their totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = pa.Table.from_batches([batch.slice(i, 1)])
                b = Block(row)
                own = b.count(b.tokens, np.arange(len(b.tokens)), len(b.words))
                own2 = b.count(b.bigram[b.at2], b.at2, len(b.key2))
                yield from _messages(row.column("block")[0].as_py(), [(b.words, [own]), (b.key2, [own2])], parts)

    return blocks.select("block", "held_out", "tokens", "lengths", "words", "places").mapInArrow(run, _MESSAGE)


class Counted:
    """A block with the totals that it knows so far."""

    def __init__(self, row: pa.Table, replies: pa.Table, least: int, rounds: int):
        """``replies``: answers of the first ``rounds`` rounds, with a column
        ``round``; a block without keys in a round has none."""
        self.block, self.least = Block(row), least
        b = self.block
        of = lambda name: replies.filter(pc.equal(replies.column("round"), name))
        (self.total, self.total2), (_, first2) = _read(of("words"), ROUNDS["words"])
        if len(self.total) != len(b.words) or len(self.total2) != len(b.key2):
            raise ValueError("a block's words and bigrams are not all counted")
        self.kept2 = self.total2 >= least
        self.mine2 = self.kept2 & first2
        b.trigrams(self.kept2)
        # Only words that occur often enough can begin a kept bigram.
        self.asked = np.flatnonzero(self.total >= least)
        self.sum1, self.arcs1 = (np.zeros(len(b.words), dtype=np.int64) for _ in range(2))
        if rounds < 2:
            return
        (sums, arcs, self.total3), (_, first3) = _read(of("trigrams"), ROUNDS["trigrams"])
        if len(self.total3) != len(b.key3):
            raise ValueError("a block's trigrams are not all counted")
        self.sum1[self.asked], self.arcs1[self.asked] = sums, arcs
        self.kept3 = self.total3 >= least
        self.mine3 = self.kept3 & first3
        self.contexts = np.flatnonzero(self.kept2 & (b.words[b.second] != END))
        self.sum2, self.arcs2 = (np.zeros(len(b.key2), dtype=np.int64) for _ in range(2))
        if rounds > 2:
            (self.sum2[self.contexts], self.arcs2[self.contexts]), _ = _read(of("contexts"), ROUNDS["contexts"])

    def trigram_kinds(self) -> list[tuple[np.ndarray, list[np.ndarray]]]:
        b = self.block
        sums, arcs = _sums(b.first[self.mine2], self.total2[self.mine2], len(b.words))
        return [(b.words[self.asked], [sums[self.asked], arcs[self.asked]]), (b.key3, [b.own3])]

    def context_kinds(self) -> list[tuple[np.ndarray, list[np.ndarray]]]:
        b = self.block
        sums, arcs = _sums(b.parent[self.mine3], self.total3[self.mine3], len(b.key2))
        return [(b.key2[self.contexts], [sums[self.contexts], arcs[self.contexts]])]


def _sums(context: np.ndarray, total: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences and number of the n-grams of each context."""
    sums = np.zeros(size, dtype=np.int64)
    np.add.at(sums, context, total)
    return sums, np.bincount(context, minlength=size)


# -- the automaton -------------------------------------------------------------


class UnigramModel:
    """Totals of the training tokens and the smoothed unigram probability."""

    def __init__(self, tokens: int, types: int, once: int, twice: int):
        self.tokens, self.types = tokens, types
        self.discount = min(0.95, max(0.1, once / (once + 2 * twice) if once + twice else 0.5))

    def probability(self, count: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.ones(len(count))
        unknown = self.discount * self.types / self.tokens
        return np.where(count > 0, (count - self.discount) / self.tokens, unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (self.tokens + 0.1 * (self.types + 1)))


def _left(total: np.ndarray, kept: np.ndarray, arcs: np.ndarray) -> np.ndarray:
    """Weight of the failure arcs of contexts that occur ``total`` times and
    whose arcs are ``arcs`` kept n-grams of ``kept`` occurrences."""
    whole = np.maximum(total, 1)
    return np.where(arcs > 0, (whole - kept + DISCOUNT * arcs) / whole, 1.0)


class Automaton:
    """States are numbers, the root is 0; words are places in a vocabulary.

    ``arcs``: (state, word, log10 probability, state it leads to), the root's
    apart: ``root`` is (log10 probability, state it leads to) for every word.
    ``failure``: (log10 weight, state it leads to) for every state.
    """

    def __init__(self, arcs: tuple[np.ndarray, ...], root: tuple[np.ndarray, np.ndarray], failure: tuple[np.ndarray, np.ndarray]):
        state, word, weight, target = arcs
        self.root_weight, self.root_target = root
        self.failure_weight, self.failure_target = failure
        self.width = len(self.root_weight)
        key = state * self.width + word
        order = np.argsort(key)
        # The last key is none that is ever asked for.
        self.keys = np.append(key[order], np.iinfo(np.int64).max)
        self.weight, self.target = weight[order], target[order]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after each walk read its word, and the log-probabilities
        collected on the way."""
        state, gained, after = state.copy(), np.zeros(len(state)), np.empty_like(state)
        walking = np.arange(len(state))
        while True:
            rooted = state[walking] == 0
            at_root, walking = walking[rooted], walking[~rooted]
            gained[at_root] += self.root_weight[word[at_root]]
            after[at_root] = self.root_target[word[at_root]]
            if not len(walking):
                return after, gained
            key = state[walking] * self.width + word[walking]
            at = np.searchsorted(self.keys, key)
            taken = self.keys[at] == key
            done, at = walking[taken], at[taken]
            gained[done] += self.weight[at]
            after[done] = self.target[at]
            walking = walking[~taken]
            gained[walking] += self.failure_weight[state[walking]]
            state[walking] = self.failure_target[state[walking]]

    def walk(self, tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 probability of every text. Texts lie end to end in ``tokens``;
        the first token of each is read but not scored."""
        # Lanes of at most LANE scored tokens.
        lanes = -(-(lengths - 1) // LANE)
        text = np.repeat(np.arange(len(lengths)), lanes)
        number = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = starts[text] + 1 + number * LANE
        size = np.minimum(LANE, starts[text] + lengths[text] - begin)
        order = np.argsort(-size, kind="stable")
        text, number, begin, size = text[order], number[order], begin[order], size[order]
        state = np.zeros(len(text), dtype=np.int64)
        further = np.flatnonzero(number > 0)  # two tokens before them
        state[further], _ = self.step(state[further], tokens[begin[further] - 2])
        state, _ = self.step(state, tokens[begin - 1])
        score = np.zeros(len(text))
        for t in range(int(size.max(initial=0))):
            n = int(np.searchsorted(-size, -t, side="left"))  # lanes longer than t
            state, gained = self.step(state[:n], tokens[begin[:n] + t])
            score[:n] += gained
        return np.bincount(text, weights=score, minlength=len(lengths))


def automaton(counted: Counted, unigrams: UnigramModel) -> Automaton:
    """The states and arcs that a block's texts can reach."""
    c, b = counted, counted.block
    of_word = np.where(c.arcs1 > 0, np.cumsum(c.arcs1 > 0), 0)  # its state, or the root
    n = int((c.arcs1 > 0).sum())
    of_bigram = np.where(c.arcs2 > 0, n + np.cumsum(c.arcs2 > 0), 0)
    # The longest context that a bigram ends with.
    reached = np.where(of_bigram > 0, of_bigram, of_word[b.second])

    p1 = unigrams.probability(c.total)
    left1, left2 = _left(c.total, c.sum1, c.arcs1), _left(c.total2, c.sum2, c.arcs2)
    two = np.flatnonzero(c.kept2)
    p2 = np.zeros(len(b.key2))
    p2[two] = (c.total2[two] - DISCOUNT) / c.total[b.first[two]] + left1[b.first[two]] * p1[b.second[two]]
    three = np.flatnonzero(c.kept3)
    parent, tail = b.parent[three], b.tail[three]
    p3 = (c.total3[three] - DISCOUNT) / c.total2[parent] + left2[parent] * p2[tail]

    words, bigrams = np.flatnonzero(of_word), np.flatnonzero(of_bigram)
    return Automaton(
        (
            np.concatenate([of_word[b.first[two]], of_bigram[parent]]),
            np.concatenate([b.second[two], b.second[tail]]),
            np.log10(np.concatenate([p2[two], p3])),
            np.concatenate([reached[two], reached[tail]]),
        ),
        (np.log10(p1), of_word),
        (
            np.log10(np.concatenate([[1.0], left1[words], left2[bigrams]])),
            np.concatenate([[0], np.zeros(n, dtype=np.int64), of_word[b.second[bigrams]]]),
        ),
    )


def _score_block(row: pa.Table, replies: pa.Table, unigrams: UnigramModel, least: int) -> pa.Table:
    counted = Counted(row, replies, least, 3)
    b = counted.block
    score = automaton(counted, unigrams).walk(b.tokens, b.starts, b.lengths)
    # START is no token of the texts.
    token = np.ones(len(b.tokens), dtype=bool)
    token[b.starts] = False
    text = np.repeat(np.arange(len(b.lengths)), b.lengths)[token]
    of_text = lambda values: np.bincount(text, weights=values[b.tokens][token], minlength=len(b.lengths))
    return pa.table(
        {
            "doc_id": row.column("doc_ids").combine_chunks().flatten(),
            "held_out": pa.array(b.held),
            "n_tokens": pa.array(b.lengths - 1),
            "n_known": pa.array(of_text(counted.total > 0).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(b.lengths), unigrams.tokens), pa.int64()),
            "base_score": pa.array(of_text(unigrams.base(counted.total))),
            "score": pa.array(score),
        }
    )


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    for every row.

    Texts whose crc32(doc_id) mod 10 is 0 are held out, all others are learnt
    from. Tokens are the lower-cased (A-Z) words and one end mark. NULL and
    empty texts are the end mark alone; repeated rows count and are scored
    each; without any training text every probability is one. Other columns
    are ignored, whatever their names.
    """
    spark = docs.sparkSession
    blocks = materialize(token_blocks(docs, doc_id, text), "lm-blocks")
    tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
    parts = max(1, -(-tokens // PART_KEYS))

    def replies(*rounds: tuple[str, DataFrame]) -> DataFrame:
        out = None
        for name, answers in rounds:
            rows = answers.where("block IS NOT NULL").select(
                F.col("block").alias("to"), "part", "totals", "firsts", F.lit(name).alias("round")
            )
            out = rows if out is None else out.unionByName(rows)
        return out

    def meet(answers: DataFrame, run, schema: str) -> DataFrame:
        return blocks.groupBy("block").cogroup(answers.groupBy("to")).applyInArrow(run, schema)

    def next_messages(make, rounds: int):
        def run(row: pa.Table, answers: pa.Table) -> pa.Table:
            kinds = make(Counted(row, answers, least, rounds))
            sent = list(_messages(row.column("block")[0].as_py(), kinds, parts))
            empty = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("keys", _BINARIES), ("values", _BINARIES)])
            return pa.Table.from_batches(sent, schema=empty)

        return run

    first = _answered(_first_messages(blocks, parts), ROUNDS["words"], parts, "lm-words")
    stats = first.where("block IS NULL").agg(*[F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(4)]).first()
    unigrams = UnigramModel(*stats)
    sent = meet(replies(("words", first)), next_messages(Counted.trigram_kinds, 1), _MESSAGE)
    second = _answered(sent, ROUNDS["trigrams"], parts, "lm-trigrams")
    known = [("words", first), ("trigrams", second)]
    sent = meet(replies(*known), next_messages(Counted.context_kinds, 2), _MESSAGE)
    third = _answered(sent, ROUNDS["contexts"], parts, "lm-contexts")
    model = ship(spark, (unigrams, least))

    def run(row: pa.Table, answers: pa.Table) -> pa.Table:
        return _score_block(row, answers, *shipped(model))

    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return meet(replies(*known, ("contexts", third)), run, schema)
