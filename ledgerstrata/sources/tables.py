"""Scans of stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampType

from ledgerstrata.schemas import AUDIT, TABLE_YEAR_RANGE, TABLES, YEAR_BUCKET


def table_path(root: str, name: str) -> str:
    """``{root}/{layer}/{table}``."""
    return f"{root.rstrip('/')}/{TABLES[name][0]}/{name}"


def read_table(
    spark: SparkSession,
    root: str,
    name: str,
    *,
    years: tuple[int, int] | None = None,
    audit: bool = False,
) -> DataFrame:
    """A stored table with its declared schema: no inference, no footer merging.

    Filters and projections chained on the result reach the Parquet scan, and
    a predicate on ``fiscal_year`` selects directories. ``raw_financials`` has
    year buckets instead; there ``years`` (first and last) selects them.
    ``audit`` adds the load timestamps.
    """
    _, schema, partition_by, _ = TABLES[name]
    fields = list(schema.fields)
    if audit:
        fields += [StructField(c, TimestampType()) for c in AUDIT.get(name, ())]
    names = [field.name for field in fields]
    if partition_by == YEAR_BUCKET:
        fields.append(StructField(YEAR_BUCKET, IntegerType()))
    stored = spark.read.schema(StructType(fields)).parquet(table_path(root, name))
    if years is not None:
        stored = stored.where(F.col("fiscal_year").between(*years))
        if partition_by == YEAR_BUCKET:
            # Years beyond the buckets share the one without a value.
            inside = F.col(YEAR_BUCKET).between(*years)
            first, last = TABLE_YEAR_RANGE
            whole = first <= years[0] and years[1] <= last
            stored = stored.where(inside if whole else inside | F.col(YEAR_BUCKET).isNull())
    return stored.select(*names)


def with_tickers(df: DataFrame, tickers: Sequence[str], companies: DataFrame | None = None) -> DataFrame:
    """Rows of the companies with the given tickers, all companies that share one included.

    Stored tables are clustered by company id, not by ticker. With the company
    dimension at hand the least and largest id of those companies bound the scan
    through scalar subqueries, which skips the row groups outside.
    """
    wanted = F.col("ticker").isin(*tickers)
    if companies is None:
        return df.where(wanted)
    # A range per ticker: one range over all would span what lies between them.
    ranges = []
    for ticker in tickers:
        ids = companies.where(F.col("ticker") == ticker)
        low, high = ids.agg(F.min("cik")).scalar(), ids.agg(F.max("cik")).scalar()
        ranges.append(F.col("cik").between(low, high))
    return df.where(wanted & reduce(lambda a, b: a | b, ranges))
