"""Ratio queries on ``financial_ratios``. Constants are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstrata.functions import cagr_ratio

BILLION = 1_000_000_000


def latest_year(df: DataFrame) -> Column:
    """Greatest fiscal year of a table as a scalar subquery: resolved once at run
    time, after which it prunes partitions."""
    return df.agg(F.max("fiscal_year")).scalar()


def top_profit_margin(ratios: DataFrame, *, min_revenue: float = BILLION, limit: int = 25) -> DataFrame:
    return (
        ratios.where(F.col("fiscal_year") == latest_year(ratios))
        .where((F.col("revenue") > min_revenue) & F.col("net_profit_margin_pct").isNotNull())
        .orderBy(F.desc("net_profit_margin_pct"), "cik")
        .limit(limit)
        .select(
            "company_name",
            "ticker",
            "fiscal_year",
            "net_profit_margin_pct",
            "revenue",
            "net_income",
            "return_on_equity_pct",
        )
    )


def top_roe_by_sector(ratios: DataFrame, *, year: int = 2023, per_sector: int = 5) -> DataFrame:
    """Best return on equity per sector. The rank limit is applied per task
    before the sector shuffle, so a large sector does not travel whole."""
    rank = F.row_number().over(
        Window.partitionBy("sector").orderBy(F.desc("return_on_equity_pct"), "cik")
    )
    return (
        ratios.where(
            (F.col("fiscal_year") == year)
            & F.col("sector").isNotNull()
            & (F.col("return_on_equity_pct") > 0)
        )
        .withColumn("rank", rank)
        .where(F.col("rank") <= per_sector)
        .orderBy("sector", "rank")
        .select(
            "sector",
            "company_name",
            "ticker",
            "fiscal_year",
            "return_on_equity_pct",
            "net_profit_margin_pct",
            "debt_to_equity_ratio",
        )
    )


def weak_liquidity(
    ratios: DataFrame, *, since: int = 2020, below: float = 1.0, limit: int = 100
) -> DataFrame:
    return (
        ratios.where((F.col("fiscal_year") >= since) & (F.col("current_ratio") < below))
        .orderBy("current_ratio", F.desc("fiscal_year"), "cik")
        .limit(limit)
        .select(
            "company_name",
            "ticker",
            "sector",
            "fiscal_year",
            "current_ratio",
            "quick_ratio",
            "cash_ratio",
            F.col("current_liabilities").alias("current_liabilities_usd"),
        )
    )


def revenue_cagr(
    ratios: DataFrame,
    *,
    first: int = 2020,
    last: int = 2023,
    min_years: int = 3,
    limit: int = 50,
) -> DataFrame:
    """Compound revenue growth between two full years."""
    year = F.col("fiscal_year")
    begin, end = f"revenue_{first}", f"revenue_{last}"
    rate = f"revenue_cagr_{last - first}yr_pct"
    return (
        ratios.where(year.between(first, last))
        .groupBy("cik", "company_name", "ticker")
        .agg(
            F.min(F.when(year == first, F.col("revenue"))).alias(begin),
            F.max(F.when(year == last, F.col("revenue"))).alias(end),
            F.count_distinct("fiscal_year").alias("years_of_data"),
        )
        .where(
            (F.col("years_of_data") >= min_years)
            & (F.col(begin) > 0)
            & (F.col(end) > F.col(begin))
        )
        .withColumn(rate, F.round(cagr_ratio(end, begin, last - first), 4) * 100)
        .orderBy(F.desc(rate), "cik")
        .limit(limit)
        .select(
            "company_name",
            "ticker",
            begin,
            end,
            (F.col(end) - F.col(begin)).alias("revenue_growth_absolute"),
            rate,
        )
    )


def high_leverage(
    ratios: DataFrame,
    *,
    year: int = 2023,
    min_debt_to_equity: float = 2.0,
    min_assets: float = BILLION,
    limit: int = 50,
) -> DataFrame:
    return (
        ratios.where(
            (F.col("fiscal_year") == year)
            & (F.col("debt_to_equity_ratio") > min_debt_to_equity)
            & (F.col("total_assets") > min_assets)
        )
        .orderBy(F.desc("debt_to_equity_ratio"), "cik")
        .limit(limit)
        .select(
            "company_name",
            "ticker",
            "sector",
            "fiscal_year",
            "debt_to_equity_ratio",
            "debt_to_assets_pct",
            "long_term_debt_to_equity",
            "total_assets",
            "stockholders_equity",
        )
    )


def profitability_trend(
    ratios: DataFrame, *, year: int = 2023, top: int = 10, since: int = 2020
) -> DataFrame:
    """Margins over the years of the companies with the highest revenue in ``year``."""
    largest = (
        ratios.where(F.col("fiscal_year") == year)
        .orderBy(F.desc_nulls_last("revenue"), "cik")
        .limit(top)
        .select("cik")
    )
    # ``largest`` has at most ``top`` rows by construction.
    return (
        ratios.where(F.col("fiscal_year") >= since)
        .join(F.broadcast(largest), "cik", "left_semi")
        .orderBy("company_name", "fiscal_year")
        .select(
            "company_name",
            "ticker",
            "fiscal_year",
            "gross_margin_pct",
            "operating_margin_pct",
            "net_profit_margin_pct",
            "return_on_assets_pct",
            "return_on_equity_pct",
        )
    )


def sector_comparison(ratios: DataFrame, *, since: int = 2020, digits: int = 2) -> DataFrame:
    means = {
        "avg_gross_margin_pct": "gross_margin_pct",
        "avg_operating_margin_pct": "operating_margin_pct",
        "avg_net_margin_pct": "net_profit_margin_pct",
        "avg_roe_pct": "return_on_equity_pct",
        "avg_current_ratio": "current_ratio",
    }
    return (
        ratios.where((F.col("fiscal_year") >= since) & F.col("sector").isNotNull())
        .groupBy("sector", "fiscal_year")
        .agg(
            F.count_distinct("cik").alias("company_count"),
            *[F.round(F.avg(source), digits).alias(name) for name, source in means.items()],
        )
        .orderBy("sector", "fiscal_year")
    )
