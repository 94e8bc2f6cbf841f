"""The corpus pipeline: quality rules, toxicity, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written and read again as the next one's ``docs``.
All but the last give the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallywork.llm import jaccard_join, packing, quality_rules, substring_dedup, toxicity
from tallywork.llm.common import label_sample, materialise, table

#: SQL cannot express trained scores, components and packing; tests compare with a brute-force version.
ORACLE_SQL: str | None = None

#: Near-duplicates share eight tenths of their five-word shingles.
NEAR = jaccard_join.Join(width=5, over=80)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic by a model of the labelled ones among them."""
    settings = toxicity.Settings()
    sample = label_sample(docs, table(spark, sf_dir, "labels"), "toxic", settings.bound)
    return toxicity.train(sample, settings).keep_clean(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of near-duplicates."""
    return jaccard_join.keep_one(docs, join=NEAR)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with passages that repeat across documents left in one of them."""
    return substring_dedup.remove_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("toxicity", clean),
    ("n-gram jaccard join", distinct),
    ("substring dedup", passages),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage{k + 1}")
    return docs
