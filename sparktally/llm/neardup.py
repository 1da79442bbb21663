"""MinHash near-duplicate detection with odd sketches.

1. One pass over the documents gives each text a 64-bit identity (of its
   normalised words), 128 MinHash samples folded into 32 band keys of four,
   and the samples' odd sketch: a 1024-bit parity bitmap. Texts at a
   similarity of 0.75 share no band with a chance of 5e-6.
2. Buckets with two different texts chain their texts to the bucket's
   smallest one; the connected components are coarse clusters that hold every
   candidate pair.
3. Only the texts of coarse clusters are shingled again. For every pair that
   is compared the XOR population count of the odd sketches estimates the
   similarity; pairs estimated more than six standard deviations below the
   threshold are skipped, the rest is confirmed on the full shingle sets, the
   likeliest first.
4. Components of confirmed links give each document its smallest reachable
   doc_id.

Equal texts are one node throughout, so a text held by a third of all rows
costs one comparison, and no step lists pairs of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktally.llm.common import connected_components, drop_scratch, list_array, materialize, small_batches, to_i64
from sparktally.llm.shingles import MinHash, hash_words, shingle_hashes, words_of
from sparktally.llm.verify import chunk_counts, confirmed_links

SAMPLES, ROWS, BITS = 128, 4, 1024
PERCENT = 75


def estimated(flips, samples: int = SAMPLES, bits: int = BITS):
    """Similarity of two texts estimated from the XOR population count of their
    odd sketches: the number of differing sample values that leaves so many of
    ``bits`` odd, as a share of the values of both."""
    differing = np.log(np.maximum(1 - 2 * np.asarray(flips) / bits, 1e-9)) / np.log(1 - 2 / bits)
    return 1 - differing / (2 * samples)


def max_flips(samples: int = SAMPLES, bits: int = BITS, percent: int = PERCENT, sigmas: float = 6.0) -> int:
    """Most XOR bits at which the estimated similarity is not ``sigmas``
    standard deviations (of the samples' and of the sketch's chance) below the
    threshold."""
    p = percent / 100
    differing = 2 * samples * (1 - p)
    of_sketch = np.sqrt(bits / 4 * (1 - (1 - 4 / bits) ** differing)) / (1 - 2 / bits) ** differing / (2 * samples)
    least = p - sigmas * np.hypot(np.sqrt(p * (1 - p) / samples), of_sketch)
    return int(np.flatnonzero(estimated(np.arange(bits // 2), samples, bits) >= least)[-1])


def text_identity(words: list[bytes]) -> int:
    """Signed 64-bit hash of the normalised word sequence."""
    h = xxhash.xxh64_intdigest(b" ".join(words), seed=1)
    return h - (1 << 64) if h >> 63 else h


def _signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, node, n_shingles, bands, sketch); node NULL without
    words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(SAMPLES, ROWS, BITS)
        for batch in small_batches(batches, "_text"):
            node, size, bands, lengths, sketch = [], [], [np.zeros(0, np.uint64)], [], []
            for text in batch.column("_text").to_pylist():
                words = words_of(text)
                if not words:
                    node.append(None)
                    size.append(0)
                    lengths.append(0)
                    sketch.append(None)
                    continue
                distinct = np.unique(shingle_hashes(hash_words(words)))
                low = hasher.minima(distinct)
                node.append(text_identity(words))
                size.append(len(distinct))
                bands.append(hasher.band_keys(low))
                lengths.append(hasher.bands)
                sketch.append(hasher.odd_sketch(low))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_id"),
                    pa.array(node, pa.int64()),
                    pa.array(size, pa.int64()),
                    list_array(to_i64(np.concatenate(bands)), lengths),
                    pa.array(sketch, pa.binary()),
                ],
                names=["doc_id", "text_id", "node", "n_shingles", "bands", "sketch"],
            )

    return docs.mapInArrow(run, "doc_id long, text_id long, node long, n_shingles long, bands array<long>, sketch binary")


def _sets(texts: DataFrame) -> DataFrame:
    """Full sorted shingle sets of the texts that are their node's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "_text"):
            keep, sets = [], [np.zeros(0, np.uint64)]
            for k, (text, node) in enumerate(zip(batch.column("_text").to_pylist(), batch.column("item").to_pylist())):
                words = words_of(text)
                if text_identity(words) == node:
                    keep.append(k)
                    sets.append(np.unique(shingle_hashes(hash_words(words)).view(np.int64)).view(np.uint64))
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(rows) for c in ("cluster", "item", "chunks", "sketch")),
                    list_array(to_i64(np.concatenate(sets)), [len(s) for s in sets[1:]]),
                ],
                names=["cluster", "item", "chunks", "sketch", "members"],
            )

    return texts.mapInArrow(run, "cluster long, item long, chunks int, sketch binary, members array<long>")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", text_ids: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per input row. With
    ``text_ids`` also text_id, the xxhash64 of the row's text.

    Two texts are linked when their sets of five-word shingles (a shorter
    text: its word sequence) have a Jaccard similarity of 0.75 or more.
    component_id is the smallest doc_id reachable over links, kept whether it
    is the row's own. NULL or empty text and text without words: n_shingles
    0, linked with nothing, kept. Rows with NULL doc_id are not linked either:
    component_id NULL, kept. A repeated doc_id: each row follows its own
    text. Other columns are ignored, whatever their names.
    """
    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text)).alias("text_id"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    signed = materialize(_signatures(slim), "near-signatures")
    linkable = signed.where("node IS NOT NULL AND doc_id IS NOT NULL")

    bands = linkable.select("node", F.explode("bands").alias("key"))
    shared = materialize(
        bands.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .where("low != high").select("key", "low"),
        "near-buckets",
    )
    coarse = connected_components(bands.join(shared, "key").where("node != low").select("node", "low").distinct(), "node", "low")
    drop_scratch(shared)

    firsts = materialize(linkable.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "near-firsts")
    picked = materialize(
        coarse.join(firsts, "node")
        .join(signed.select("doc_id", "node", "n_shingles", "sketch"), ["doc_id", "node"])
        .select("doc_id", F.col("node").alias("item"), F.col("root").alias("cluster"), "n_shingles", "sketch")
        .dropDuplicates(["item"]),
        "near-picked",
    )
    sized = picked.withColumn("weight", F.col("n_shingles") * 8 + 128)
    members = picked.join(chunk_counts(sized, "cluster", "weight"), "cluster")
    texts = slim.join(members, "doc_id").select("cluster", "item", "chunks", "sketch", "_text")
    # Repeated rows may bring a text twice; equal items never link.
    links = confirmed_links(_sets(texts), PERCENT, max_flips()).where("a != b")
    parts = connected_components(links)

    linked = materialize(parts.join(firsts, "node").select("node", "root", "doc_id"), "near-linked")
    lowest = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    reach = materialize(linked.join(lowest, "root").select("node", "component_id"), "near-reach")
    nodes = materialize(
        firsts.join(reach, "node", "left").select("node", F.coalesce("component_id", "doc_id").alias("component_id")),
        "near-nodes",
    )
    drop_scratch(coarse, firsts, picked, parts, linked, reach)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        signed.select("doc_id", "text_id", "node", "n_shingles")
        .join(nodes, "node", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"), "text_id")
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), *(["text_id"] if text_ids else []))
    )


# Every pair of documents that share a shingle, and all links followed to the
# end: for small tables.
NEAR_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT common.a, common.b FROM common JOIN sizes x ON x.doc_id = common.a JOIN sizes y ON y.doc_id = common.b
  WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), lowest AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
), verdict AS (
  SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id
  FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON lowest.a = d.doc_id
)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM verdict
"""
