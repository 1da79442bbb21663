"""Training-corpus pipeline: toxicity, near duplicates, repeated passages,
packing. Each stage reads what the one before kept; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.llm import neardup, packing, substring, toxicity
from sparktally.llm.common import materialize
from sparktally.llm.queries import tokenizer_json
from sparktally.sources.tables import load_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold. Labels are those
    of the given documents that may be learnt from."""
    labels = load_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    learn = labels.where(toxicity.crc_mod("doc_id", 3) != 1)
    model = toxicity.train(docs, learn)
    columns = docs.columns
    renamed = docs.select([F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    scored = toxicity.score(renamed, model, f"c{columns.index('text')}")
    kept = scored.where(F.col("score") < toxicity.THRESHOLD)
    return kept.select([F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest doc_id, of each group of near
    duplicates. Documents without words or doc_id stay. Rows that share a
    doc_id but not the text are judged each by its own text; of rows that
    share both one stays."""
    verdict = neardup.near_duplicates(docs, text_ids=True)
    kept = materialize(
        verdict.where("doc_id IS NOT NULL AND kept").groupBy("doc_id", "text_id").agg(F.count("*").alias("rows")),
        "pipeline-kept",
    )
    # Positions for names, which cannot clash with those of the join.
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own, content = F.col(place["doc_id"]), F.col(place["text"])
    named = docs.select([F.col(c).alias(p) for c, p in place.items()])
    stay = named.join(kept, (own == F.col("doc_id")) & (F.xxhash64(content) == F.col("text_id")))
    out = stay.where("rows = 1").select(*place.values()).unionByName(named.where(own.isNull()))
    if not kept.where("rows > 1").isEmpty():
        again = stay.where("rows > 1").dropDuplicates(["doc_id", "text_id"])
        out = out.unionByName(again.select(*place.values()))
    return out.select([F.col(p).alias(c) for c, p in place.items()])


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier document keeps."""
    return substring.remove_passages(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents packed into sequences of 1024 tokens."""
    return packing.pack_documents(docs, tokenizer_json())


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

# Neither learnt scores nor tokenizer ids can be written in SQL; the stages
# are tested one by one in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result written as Parquet and
    read again by the next."""
    docs = load_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
