"""Point lookups: a ticker or sector and a year select directories and row groups.

``companies`` is the company dimension; with it a ticker is looked up by id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.sources.tables import with_tickers


def company_profile(
    metrics: DataFrame, ticker: str = "AAPL", year: int = 2023, companies: DataFrame | None = None
) -> DataFrame:
    return with_tickers(metrics.where(F.col("fiscal_year") == year), [ticker], companies)


def sector_listing(peers: DataFrame, sector: str = "Technology", year: int = 2023) -> DataFrame:
    return peers.where((F.col("fiscal_year") == year) & (F.col("sector") == sector)).orderBy(
        F.desc("net_margin_percentile"), "cik"
    )


def ticker_trend(
    series: DataFrame, ticker: str = "MSFT", since: int = 2020, companies: DataFrame | None = None
) -> DataFrame:
    return with_tickers(series.where(F.col("fiscal_year") >= since), [ticker], companies).orderBy(
        "fiscal_year", "fiscal_period"
    )


def ticker_ratios(
    ratios: DataFrame,
    tickers: Sequence[str] = ("AAPL", "MSFT", "GOOGL"),
    year: int = 2023,
    companies: DataFrame | None = None,
) -> DataFrame:
    return with_tickers(ratios.where(F.col("fiscal_year") == year), tickers, companies)
