"""The corpus pipeline: documents in, a deduplicated, mixed and tokenised corpus out.

1. ``quality_rules``   documents that the current rule policy rejects go
2. ``toxicity``        documents that score 0.5 or more go; learned from this stage's documents and ``labels``
3. ``near_dedup``      one document (the smallest id) of each group of near-duplicates stays: five-word shingles, similarity 0.8
4. ``mixing``          documents are repeated or left out until every source has its share of the words
5. ``byte_bpe``        token ids, their number, and whether decoding gives the text back

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the
columns of ``documents`` (the last one adds its own); ``run`` writes each
stage's result to the shared checkpoint folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import byte_bpe, mixing, near_dedup, quality_rules, toxicity
from tessera.llm.common import documents, session
from tessera.session import cut_lineage, release


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    return quality_rules.keep_good(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    return toxicity.keep_clean(docs, toxicity.learn(docs, documents(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    return near_dedup.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    return byte_bpe.with_tokens(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", byte_bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    before = None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs)
            release(before)
            before = docs
    return docs


ORACLE_SQL = None  # near-duplicate groups, the learned filter and the encoding have no SQL form; tested by brute force
