"""The queries ``opN_<name>``: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparktally.llm import (
    align, bpe, chat, fingerprint, lm, neardup, negatives, packing, substring, topk, toxicity, treebpe, warc,
)
from sparktally.sources.tables import load_table

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
RANKS = "byte_bpe_multi_50k.tiktoken"


def tokenizer_json(path: str | None = None) -> str:
    """Content of a tokenizer file (a few megabytes), read on the driver."""
    with open(path or public_tokenizers.path(TOKENIZER), encoding="utf-8") as fh:
        return fh.read()


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link_conversations(load_table(spark, sf_dir, "conversations"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_documents(docs, load_table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_embeddings(load_table(spark, sf_dir, "embeddings"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(load_table(spark, sf_dir, "documents"), tokenizer_json())


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(load_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load_table(spark, sf_dir, "documents"), tokenizer_json())


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(load_table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(load_table(spark, sf_dir, "pages"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edited(load_table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(load_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine_embeddings(load_table(spark, sf_dir, "embeddings"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path(PIECES), "rb") as fh:
        pieces = fh.read()
    return align.align(load_table(spark, sf_dir, "documents"), tokenizer_json(), pieces, digests=True)


def op13_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tokenizer_json(public_tokenizers.path(RANKS))
    return treebpe.encode_digests(load_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


QUERIES = {
    "op1_tool_calls": op1_tool_calls,
    "op2_toxicity": op2_toxicity,
    "op3_top_k": op3_top_k,
    "op4_bpe": op4_bpe,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_packing": op6_packing,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_warc": op8_warc,
    "op9_fingerprints": op9_fingerprints,
    "op10_near_dedup": op10_near_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_alignment": op12_alignment,
    "op13_tree_bpe": op13_tree_bpe,
}

# The others are tested against brute force, an exact round trip or held-out
# accuracy in tests/llm.
ORACLE_SQL = {
    "op1_tool_calls": chat.LINK_SQL,
    "op3_top_k": topk.TOP_K_SQL,
    "op8_warc": warc.ARCHIVE_SQL,
    "op10_near_dedup": neardup.NEAR_SQL,
    "op11_hard_negatives": negatives.NEGATIVES_SQL,
}
