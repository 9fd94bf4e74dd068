"""A corpus pipeline from the table of documents to packed training sequences.

Every stage works on all rows that its predecessor kept and is written as Parquet
before the next one reads it, so a lost executor costs at most one stage's tasks.
The stages state themselves what they do with NULLs, empty texts and repeated
rows; an empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerstrata.llm import stages
from ledgerstrata.llm.common import stored, table

STAGES = [
    ("quality_classifier", stages.quality_classifier),
    ("exact_dedup", stages.exact_dedup),
    ("simhash_near_dedup", stages.simhash_near_dedup),
    ("mix_to_targets", stages.mix_to_targets),
    ("best_fit_packing", stages.best_fit_packing),
]

# A trained classifier decides what the later stages see, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), f"stage-{name}")
    return rows
