"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trustgauge.llm import exactdup, mixing, neardup, packing, quality
from trustgauge.llm.common import store, table
from trustgauge.llm.queries import tokenizer

# Shingles of five words, links from a similarity of 0.8 on. A pair there shares one of the keys
# of 14 x 14 tables with probability (1 - (1 - 0.8^3)^14)^2 > 0.9999; 10 x 10 would give 0.9985.
NEAR = neardup.Settings(shingle=5, percent=80, groups=14)
MIX = mixing.Settings()


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the current policy rejects."""
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return exactdup.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    return neardup.keep_one(docs, NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, repeats as further rows."""
    return mixing.draw_mix(docs, MIX)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in a sequence of at most 4096 tokens."""
    return packing.pack_documents(docs, tokenizer()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The mix's draws and the tokenizer's ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next one reads it.

    A document without words goes in the first stage, one without id is kept by near-dedup and
    packed under a null id. Rows equal in id and text count as one from exact dedup on, until the mix
    repeats what it takes more than once. An empty table gives no pieces.
    """
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
