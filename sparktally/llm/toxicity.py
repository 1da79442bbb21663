"""Toxicity scoring after noisy-channel deobfuscation.

Spelling: a suspicious token (leetspeak inside letters, a letter twice or more
running, letters spread by separators, three or more single letters spread by
spaces) becomes a lattice: every observed character can stand for itself, for the
letters it imitates, or for nothing (a separator or a repetition), each at a
channel cost. Viterbi decoding under a character trigram model of the corpus
picks the cheapest reading; a word that only doubles a letter is also read as
it stands. Any other token's lattice has one path, the token.

Scoring: the restored words of a text are looked up, whole and by their
first letters, in a table of features that labelled toxic documents have and
clean ones do not; the evidence found goes through a logistic function fitted
on the labelled rows with each row's own contribution taken out.

The character model counts every character of every text, in Spark. The
classifier is fitted on a bounded sample: ``FIT_ROWS`` labelled rows, chosen
by a hash of the doc_id. What is shipped to the tasks has a fixed size: the
ids of the sample, a character table of 2^18 cells, as many features as ``FIT_ROWS`` texts hold
at most. Scoring is one pass over the scan without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktally.llm.common import crc_mod, drop_scratch, materialize, no_collection, ship, shipped, small_batches

CELLS = 1 << 18  # of the character model
PREFIXES = (4, 5, 6)  # letters of the prefix features
MIN_TOXIC = 3  # toxic documents that must have a feature
DECAY = 0.8  # of the weights of a text's features, the largest first
FIT_ROWS = 20_000
THRESHOLD = 0.7
CACHE_WORDS = 250_000

# What a character may imitate.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
SEPARATORS = set(".-_*~`'^,:;/\\#%&=·•")
# Channel costs, in natural-log units.
COST_IMITATE, COST_SEPARATOR, COST_REPEAT, COST_KEEP_ODD = 1.0, 1.0, 0.5, 6.0

_EDGE = ".,;:?%&*#\"'()[]{}…«»“”„-_/\\=~`^"
_ODD = "0-9@$!|+(<€£"
_SEP = r".\-_*~`'^,:;/\\#%&=·•"
# One letter twice or three times running; leetspeak or a separator between
# letters; three single letters between spaces.
_DOUBLE = re.compile(r"([^\W\d_])\1")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_SUSPECT = re.compile(rf"[^\W\d_][{_ODD}{_SEP}]+[^\W\d_]|^[{_ODD}]+[^\W\d_]|[^\W\d_][0-9@$!|+]+$|([^\W\d_])\1\1")
_SPACED = re.compile(r" ((?:[^\W_]|[@$!|+])(?: (?:[^\W_]|[@$!|+])){2,})(?!\S)")

# Character codes: letters of the basic plane as they are, all else a boundary.
BOUNDARY = 32
_CODES = np.array([c if chr(c).isalpha() else BOUNDARY for c in range(1 << 16)], dtype=np.uint64)
_STEP, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def char_cells(text: str) -> list[np.ndarray]:
    """Cells of the 1-, 2- and 3-grams of the characters of a text between
    two boundaries before and one after it; runs of boundaries count too."""
    points = np.frombuffer(f"  {text} ".encode("utf-32-le"), dtype=np.uint32)
    codes = _CODES[np.minimum(points, (1 << 16) - 1)]
    out = []
    for size in (1, 2, 3):
        n = len(codes) - 2
        key = np.full(n, np.uint64(size))
        for j in range(3 - size, 3):
            key = (key ^ codes[j : j + n]) * np.uint64(_STEP)
        out.append((key >> np.uint64(64 - 18)).astype(np.int64))
    return out


def _cell(gram: str) -> int:
    key = len(gram)
    for ch in gram:
        key = (key ^ int(_CODES[min(ord(ch), (1 << 16) - 1)])) * _STEP & _MASK
    return key >> (64 - 18)


class CharModel:
    """Interpolated character trigrams from hashed counts of a fixed size; a
    boundary is a space."""

    def __init__(self, counts: np.ndarray):
        self.counts, self.total = counts, float(counts.sum()) / 3
        self.cache: dict[str, float] = {}

    def cost(self, gram: str) -> float:
        """-ln P(gram[2] | gram[:2]); ``gram`` has three characters."""
        c = self.cache.get(gram)
        if c is None:
            if len(self.cache) > 200_000:
                self.cache.clear()
            n = self.counts
            p = (n[_cell(gram[2])] + 0.1) / (self.total + 30.0)
            p = (n[_cell(gram[1:])] + 5 * p) / (n[_cell(gram[1])] + 5)
            p = (n[_cell(gram)] + 5 * p) / (n[_cell(gram[:2])] + 5)
            c = self.cache[gram] = -float(np.log(min(1.0, max(p, 1e-12))))
        return c


def lattice_arcs(token: str, k: int) -> list[tuple[str, float]]:
    """What the character at place ``k`` may stand for, and at what cost: a
    letter or nothing."""
    ch = token[k]
    arcs = [(ch, 0.0 if ch.isalpha() else COST_KEEP_ODD)]
    arcs += [(letter, COST_IMITATE) for letter in LEET.get(ch, "")]
    if ch in SEPARATORS or ch == " ":
        arcs.append(("", COST_SEPARATOR if ch != " " else 0.0))
    elif not ch.isalpha():
        arcs.append(("", 2 * COST_SEPARATOR))
    if k and ch == token[k - 1]:
        arcs.append(("", COST_REPEAT))
    return arcs


def restore(token: str, model: CharModel) -> str:
    """The cheapest reading of a lower-case token (Viterbi over the lattice,
    state: the last two characters written)."""
    trace: list[tuple[int, str]] = []  # (previous entry, written character)
    states: dict[str, tuple[float, int]] = {"  ": (0.0, -1)}  # (cost, entry)
    for k in range(len(token)):
        arcs = lattice_arcs(token, k)
        new: dict[str, tuple[float, int]] = {}
        for state, (cost, at) in states.items():
            for written, price in arcs:
                if written:
                    total = cost + price + model.cost(state + written)
                    key = state[1] + written
                    if key not in new or total < new[key][0]:
                        trace.append((at, written))
                        new[key] = (total, len(trace) - 1)
                else:
                    total = cost + price
                    if state not in new or total < new[state][0]:
                        new[state] = (total, at)
        states = new
    end = min(states, key=lambda s: (states[s][0] + model.cost(s + " "), s))
    at, out = states[end][1], []
    while at >= 0:
        at, written = trace[at]
        out.append(written)
    return "".join(reversed(out))


def undoubled(word: str, model: CharModel) -> str:
    """``restore`` of a word of letters none of which stands three times
    running. Where its doubled letters stand apart, the lattice is a row of
    independent choices between two paths that differ in three costs."""
    places = [m.end() - 1 for m in _DOUBLE.finditer(word)]
    if any(b - a < 4 for a, b in zip(places, places[1:])):
        return restore(word, model)
    padded = "  " + word + " "
    for k in reversed(places):
        before, letter, after = padded[k], padded[k + 1], padded[k + 3]
        kept = model.cost(before + letter + letter) + model.cost(letter + letter + after)
        if COST_REPEAT + model.cost(before + letter + after) < kept:
            word = word[:k] + word[k + 1 :]
    return word


class Reader:
    """What ``value_of`` gives for the restored words of a text, through a
    bounded cache per token."""

    def __init__(self, model: CharModel, value_of):
        self.model, self.value_of = model, value_of
        self.cache: dict[str, object] = {}

    def words(self, token: str) -> tuple[str, ...]:
        """The restored word; of a word that only doubles a letter both
        readings, as many words are rightly spelt so."""
        word = token.strip(_EDGE)
        plain = word.isalpha()
        if word and (" " in word or (_TRIPLE if plain else _SUSPECT).search(word)):
            return (restore(word, self.model).rstrip("!"),)
        if plain and _DOUBLE.search(word):
            return word, undoubled(word, self.model)
        return (word.rstrip("!"),)

    def read(self, text: str) -> set:
        low = text.lower()
        tokens = set(low.split())
        tokens.update(_SPACED.findall(" " + low.replace("\n", "  ")))
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        cache = self.cache
        for token in tokens.difference(cache):
            cache[token] = tuple(map(self.value_of, self.words(token)))
        return set().union(*map(cache.__getitem__, tokens))


def features(word: str) -> tuple[int, ...]:
    """Signed 64-bit hashes of a word: whole, and its beginnings."""
    if not word:
        return ()
    names = ["=" + word, *(word[:n] for n in PREFIXES if len(word) >= n)]
    return tuple(h - (1 << 64) if h >> 63 else h for h in map(xxhash.xxh64_intdigest, names))


def character_counts(docs: DataFrame, text: str) -> np.ndarray:
    """Hashed character n-gram counts of every text: a vector of ``CELLS``
    numbers, summed in Spark."""
    slim = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, dtype=np.int64)
        for batch in small_batches(batches, "_text", 1 << 20):
            joined = " ".join(batch.column("_text").to_pylist()).lower()
            for a in range(0, len(joined), 1 << 20):  # a very long text in parts
                for cells in char_cells(joined[a : a + (1 << 20)]):
                    total += np.bincount(cells, minlength=CELLS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    # At most CELLS rows reach the driver.
    found = slim.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CELLS)
    counts[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return counts


def _feature_rows(labelled: DataFrame, counts) -> DataFrame:
    """(feature, a, b): toxic and clean documents that have it, per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(CharModel(counts.value), features)
        for batch in small_batches(batches, "_text"):
            seen = Counter(), Counter()
            for t, y in zip(batch.column("_text").to_pylist(), batch.column("toxic").to_pylist()):
                seen[y].update(set().union(*reader.read(t)))
            names = np.array(list(seen[0].keys() | seen[1].keys()), dtype=np.int64)
            for a in range(0, len(names), 1 << 17):
                some = names[a : a + (1 << 17)]
                both = [pa.array([seen[y][f] for f in some.tolist()], pa.int64()) for y in (1, 0)]
                yield pa.RecordBatch.from_arrays([pa.array(some), *both], names=["feature", "a", "b"])

    return labelled.mapInArrow(run, "feature long, a long, b long")


def _log_odds(a: np.ndarray, b: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Log-odds of the label given a feature seen in a toxic and b clean
    documents of n1 and n0, one clean document per class ratio added, less
    one standard error: rare features weigh little."""
    a, b = np.maximum(a, 0.0), np.maximum(b, 0.0)
    weight = np.log((a + 0.1) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1))
    return weight - 1.0 / np.sqrt(a + 0.5)


def evidence(weights: np.ndarray) -> np.ndarray:
    """Three numbers from the positive weights of a text's features: the
    largest, the sum of all with geometrically falling shares, the largest
    first, whether there is any."""
    w = np.sort(weights[weights > 0])[::-1]
    return np.array([w[0], w @ DECAY ** np.arange(len(w)), 1.0]) if len(w) else np.zeros(3)


def _fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the constant comes last."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([0.02] * (x.shape[1] - 1) + [1e-4])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge @ w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class ToxicityModel:
    """What scoring needs: character counts, feature weights, the logistic
    function. Bounded by CELLS and by the features of FIT_ROWS texts."""

    def __init__(self, counts: np.ndarray, weights: dict[int, float], logistic: np.ndarray):
        self.counts, self.weights, self.logistic = counts, weights, logistic

    def reader(self) -> Reader:
        known = self.weights
        return Reader(CharModel(self.counts), lambda word: tuple(f for f in features(word) if f in known))

    def score(self, found: set) -> float:
        """Score of what the reader found in a text."""
        weights = np.array([self.weights[f] for f in set().union(*found)])
        x = np.append(evidence(weights), 1.0)
        return float(1 / (1 + np.exp(-np.clip(x @ self.logistic, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> ToxicityModel:
    """Fit on ``FIT_ROWS`` of the given labelled rows (rows of ``labels`` that
    may be learnt from); character counts cover all of ``docs``. Repeated
    labels of one doc_id count as toxic if any is; NULL labels, ids and texts
    are left out. Without a toxic or without a clean row every score is the
    share of toxic rows (0 without any)."""
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(character_counts(docs, text))
    known = (
        labels.where(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("_id")).agg(F.max(toxic).cast("int").alias("toxic"))
        .join(docs.select(F.col(doc_id).alias("_id")), "_id", "left_semi")
    )
    # At most FIT_ROWS ids, so the texts are not shuffled.
    sample = F.broadcast(known.orderBy(F.xxhash64("_id"), "_id").limit(FIT_ROWS))
    labelled = materialize(
        docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).where("_text IS NOT NULL")
        .join(sample, "_id").select("toxic", "_text"),
        "tox-labelled",
    )
    sizes = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        share = np.clip(n1 / max(1, n1 + n0), 1e-9, 1 - 1e-9)
        drop_scratch(labelled)
        return ToxicityModel(counts.value, {}, np.array([0.0, 0.0, 0.0, np.log(share / (1 - share))]))
    per = _feature_rows(labelled, counts).groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    strong = per.where((F.col("a") >= MIN_TOXIC) & (F.col("a") * n0 > F.lit(4) * F.col("b") * n1))
    # Features of at most FIT_ROWS texts.
    best = strong.orderBy("feature").toArrow()
    names = best.column("feature").to_pylist()
    ab = np.column_stack([best.column(c).to_numpy().astype(float) for c in ("a", "b")])
    table = dict(zip(names, map(tuple, ab.tolist())))
    strong_features = spark.sparkContext.broadcast(table)

    def collect_evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_features = strong_features.value
        reader = Reader(CharModel(counts.value), lambda word: tuple(f for f in features(word) if f in known_features))
        for batch in small_batches(batches, "_text"):
            out: list[list] = [[], [], [], []]
            for t, y in zip(batch.column("_text").to_pylist(), batch.column("toxic").to_pylist()):
                own = [known_features[f] for f in set().union(*reader.read(t))]
                a = np.array([p[0] for p in own], dtype=float) - (y == 1)
                b = np.array([p[1] for p in own], dtype=float) - (y == 0)
                ok = a >= MIN_TOXIC - 1
                x = evidence(_log_odds(a[ok], b[ok], n1 - (y == 1), n0 - (y == 0)))
                for k, v in enumerate((*x, y)):
                    out[k].append(float(v))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in out], names=["x0", "x1", "x2", "y"])

    points = labelled.mapInArrow(collect_evidence, "x0 double, x1 double, x2 double, y double").toArrow()
    x = np.column_stack([points.column(c).to_numpy() for c in ("x0", "x1", "x2")])
    logistic = _fit_logistic(x, points.column("y").to_numpy())
    w = _log_odds(ab[:, 0], ab[:, 1], n1, n0)
    drop_scratch(labelled)
    return ToxicityModel(counts.value, {f: float(v) for f, v in zip(names, w) if v > 0}, logistic)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) appended or replaced. NULL and empty
    texts have no evidence and get the score of such a text; very long texts
    are read whole; other columns pass through unchanged."""
    sent = ship(docs.sparkSession, model)
    rest = [c for c in docs.columns if c != "score"]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with no_collection():
            fitted = shipped(sent)
            reader = fitted.reader()
            for batch in small_batches(batches, text):
                scores = [fitted.score(reader.read(t or "")) for t in batch.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(scores, pa.float64())], names=[*rest, "score"])

    return docs.select(*rest).mapInArrow(run, f"{schema}, score double")


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``. Labels of
    held-out rows (crc32(doc_id) mod 3 = 1) are never read; predicted is 1
    from a score of 0.7."""
    learn = labels.where(crc_mod(doc_id, 3) != 1)
    model = train(docs, learn, doc_id, text)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    return score(slim, model, "_text").select(
        "doc_id",
        (crc_mod("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
