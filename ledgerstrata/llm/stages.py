"""The operators as stages that take and return the rows of ``documents``.

A stage takes (spark, docs, sf_dir). Those that filter return the rows that stay
with all their columns, as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerstrata.llm.common import table, vocabulary
from ledgerstrata.llm.exact_dedup import drop_exact_copies
from ledgerstrata.llm.mixing import sample_mix
from ledgerstrata.llm.near_copies import drop_similar
from ledgerstrata.llm.packing import pack
from ledgerstrata.llm.quality_model import keep_quality

# Share of the tokens that the mix keeps; mixing is the stage that may drop clean documents.
MIX_BUDGET = 0.8
SEQUENCE = 2048


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies proposed by SimHash (and, beyond its three bits, by MinHash), decided
    by exact similarity; op4 keeps its contract of three bits alone."""
    return drop_similar(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sample_mix(docs, budget_share=MIX_BUDGET)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, vocabulary("word_bpe_49k.json"), SEQUENCE, words="dropped")
